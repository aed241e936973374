"""The customer jobs from file to file.

Each job reads its record files through their layouts, with the record sequence (so that "first" and
positions are those of the files), runs the plan of its module, and publishes its outputs in the
specified order as one generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.plans import addresses, names, owners, parties, relationships, report
from recsmith.session import materialize
from recsmith.sinks.generations import Generations
from recsmith.sources.layout import Layout
from recsmith.sources.readers import SEQ, read_delimited, read_fixed_binary, read_fixed_text

Paths = str | Sequence[str]


def text(spark: SparkSession, path: Paths, layout: Layout) -> DataFrame:
    return read_fixed_text(spark, path, layout, sequence=SEQ)


def binary(spark: SparkSession, path: Paths, layout: Layout, **options) -> DataFrame:
    return read_fixed_binary(spark, path, layout.lrecl, layout, sequence=SEQ, **options)


def owners_job(spark: SparkSession, accounts: Paths, relations: Paths, out: Generations) -> int:
    """PIPE-06: account relationships (several files, one input) and customer relationships in; the owner
    file, by account, customer and second customer, out."""
    rows = owners.account_owners(read_fixed_text(spark, accounts, owners.ACCOUNT_REL_LAYOUT),
                                 read_fixed_text(spark, relations, owners.CUST_REL_LAYOUT))
    # Of equal customers and accounts the other fields, as rendered, are what tells two lines apart. They
    # are stored as rendered, once, and not made anew to be sampled, dealt out and compared.
    ties = {f.name: F.rpad(f.name, f.width, " ") for f in owners.OWNER_LAYOUT.fields if f.name in ("ACCTCODE", "RLENCODE", "CODE1", "CODE2")}
    return out.publish({"owners": (materialize(rows.withColumns(ties), "owners"), ["ACCTNOC", "CUSTNO", "CUSTNO2", *ties],
                                   owners.OWNER_LAYOUT.render_expr())})


def names_job(spark: SparkSession, name_file: Paths, remark_file: Paths, out: Generations) -> int:
    """PIPE-05: the first name and the first remark of each customer, by customer."""
    rows = names.names_with_long_name(text(spark, name_file, names.NAME_IN_LAYOUT), text(spark, remark_file, names.REMARK_LAYOUT))
    return out.publish({"names": (materialize(rows, "names"), ["CUSTNO"],
                                  names.NAME_OUT_LAYOUT.render_expr({"CUSTNAME_2": F.col("CUSTNAME")}))})


def deposit_addresses_job(spark: SparkSession, ownership: Paths, addresses_: Paths, out: Generations) -> int:
    """PIPE-07: binary ownership records and address lines in; the listing, by account, out."""
    own = binary(spark, ownership, names.OWNERSHIP_LAYOUT, columns=["O_APPL_CODE", "ACCTNO", *names.LINE_TYPES])
    rows = names.deposit_addresses(own, text(spark, addresses_, names.ADDRESS_LAYOUT))
    return out.publish({"addresses": (materialize(rows, "addresses"), ["ACCTNO"], names.DEPOSIT_ADDR_LAYOUT.render_expr())})


def relationships_job(spark: SparkSession, rel: Paths, codes: Paths, name_file: Paths, aliases: Paths,
                      customers: Paths, run_date: str, out: Generations) -> int:
    """PIPE-01 and PIPE-02: binary relationships and four lookup files in; the relationship file, the search
    file and the list of duplicates out, together. The both-sides rows are computed once."""
    both = relationships.enrich_both_sides(
        binary(spark, rel, relationships.REL_LAYOUT), text(spark, codes, relationships.CODE_LAYOUT),
        text(spark, name_file, relationships.NAME_LAYOUT), text(spark, aliases, relationships.ALIAS_LAYOUT),
        text(spark, customers, relationships.CUSTOMER_LAYOUT))
    value = relationships.BOTH_LAYOUT.render_expr().alias("value")

    def lines(records: DataFrame) -> tuple[DataFrame, list]:
        return materialize(records.withColumnRenamed("record", "value"), "relationship-lines"), ["value"]

    return out.publish_from(both, {
        "both": lambda rows: (rows.select(value), ["value"]),
        "search": lambda rows: lines(relationships.search_file(rows, run_date)),
        "duplicates": lambda rows: lines(relationships.duplicate_file(rows, run_date))})


def parties_job(spark: SparkSession, search: Paths, accounts: Paths, out: Generations) -> int:
    """PIPE-03: the search file and the personal accounts in; both layouts out, together, from one stored frame."""
    rows = parties.parties_with_accounts(text(spark, search, parties.SEARCH_LAYOUT),
                                         read_fixed_text(spark, accounts, parties.ACCOUNT_LAYOUT))

    def ordered(layout: Column):
        def lines(stored: DataFrame) -> tuple[DataFrame, list]:
            order = {f"_o{i}": c for i, c in enumerate(parties.party_order(stored))}
            return stored.withColumns(order).select(*order, layout.alias("value")), list(order)
        return lines

    return out.publish_from(rows, {"fixed": ordered(parties.PARTY_LAYOUT.render_expr()),
                                   "quoted": ordered(parties.quoted_record())})


def address_job(lines: DataFrame, elements: DataFrame, out: Generations) -> int:
    """PIPE-08: the verify report and the update file, together, from one repaired and stored frame."""
    def verify(rows: DataFrame) -> tuple[DataFrame, list]:
        return addresses.verify_report(rows), ["line_no"]

    def update(rows: DataFrame) -> tuple[DataFrame, list]:
        return rows.select("CUSTNO", "ADDREF", addresses.update_record().alias("value")), ["CUSTNO", "ADDREF", "value"]

    return out.publish_from(addresses.repaired(lines, elements), {"verify": verify, "update": update})


def deposits(spark: SparkSession, path: Paths) -> DataFrame:
    """PIPE-11: accounts of the multi-format deposit file, classified; one per account, the first read."""
    dp = binary(spark, path, report.DEPOSIT_LAYOUT, columns=report.DEPOSIT_FIELDS, where=report.DEPOSIT_RECORDS)
    return report.deposit_accounts(dp)


def deposit_details(spark: SparkSession, path: Paths, statements: Paths, posts: Paths, holds: Paths) -> DataFrame:
    """PIPE-11: deposit accounts with statement cycle, post indicator and holds, merged by position as the
    files hold them."""
    return report.with_details(deposits(spark, path), binary(spark, statements, report.STATEMENT_LAYOUT),
                               text(spark, posts, report.POST_LAYOUT), text(spark, holds, report.HOLD_LAYOUT))


def report_job(spark: SparkSession, customers: DataFrame, files: dict[str, Paths], out: Generations) -> int:
    """PIPE-11: the customer table and twelve files (alias list, code tables, products and their details) in;
    the raw file and the report out, together. ``files``: requests, occupations, masco, msic,
    branches, deposits, loans, boxes, unicard, comcard, statements, posts, holds."""
    requests = read_delimited(spark, files["requests"], report.REQUEST_COLUMNS, max_width=report.REQUEST_WIDTHS)
    occupations = text(spark, files["occupations"], report.OCCUPATION_LAYOUT).where("TYPE = 'OCCUP'")
    boxes, branches = text(spark, files["boxes"], report.BOX_LAYOUT), text(spark, files["branches"], report.BRANCH_LAYOUT)
    loans = binary(spark, files["loans"], report.LOAN_LAYOUT, columns=report.LOAN_FIELDS)
    described = report.describe(report.requested_customers(requests, customers), occupations,
                                text(spark, files["masco"], report.MASCO_LAYOUT), text(spark, files["msic"], report.MSIC_LAYOUT))
    products = report.merged_products(report.with_safe_boxes(described, boxes, customers), [
        report.with_branch(deposits(spark, files["deposits"]), branches), report.with_branch(report.loan_accounts(loans), branches),
        report.box_accounts(boxes), *[report.card_accounts(text(spark, files[c], report.CARD_LAYOUT)) for c in ("unicard", "comcard")]])
    # Both outputs are made of the products: each is computed once.
    products = [materialize(p, "product") for p in products]
    details = (binary(spark, files["statements"], report.STATEMENT_LAYOUT), text(spark, files["posts"], report.POST_LAYOUT),
               text(spark, files["holds"], report.HOLD_LAYOUT))
    rows = report.report_rows([report.with_details(products[0], *details), *products[1:]])
    return out.publish({"raw": (report.raw_records(products), ["SRC", "ACCTNOC", "value"]),
                        "report": (report.report_lines(rows), ["line_no"])})
