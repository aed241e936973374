"""Record files: sequence over splits, binary source and sink, published generations, merges by position."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from recsmith.operators import joins as JN
from recsmith.operators.dedup import first_per_key, first_record
from recsmith.plans import files as FJ
from recsmith.sinks import writers as W
from recsmith.sinks.generations import Generations
from recsmith.sources import readers as RD
from recsmith.sources.layout import Layout, binary_record


@pytest.fixture
def small_splits(spark):
    """Files of a few kilobytes are read in many splits, and small partitions stay apart."""
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def write_text(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.writelines(x + "\n" for x in lines)


def test_sequence_is_input_order(spark, small_splits, tmp_path):
    """Two inputs of several files, each read in several splits: numbers are those of the lines."""
    rng = random.Random(2)
    lines = [f"{rng.randrange(60):03d} {i:05d} {'x' * rng.randrange(20)}" for i in range(1500)]
    write_text(f"{tmp_path}/b", "part-00000.txt", lines[:400])
    write_text(f"{tmp_path}/b", "part-00001.txt", lines[400:900])
    write_text(f"{tmp_path}/a", "part-00000.txt", lines[900:])
    lay = Layout.of([("KEY", 1, 3), ("NO", 5, 5, "n")])
    rows = RD.read_fixed_text(spark, [f"{tmp_path}/b", f"{tmp_path}/a"], lay, sequence=RD.SEQ)
    assert rows.rdd.getNumPartitions() > 6
    numbered = RD.record_numbers(rows).collect()
    assert sorted((r.line_no, r.NO) for r in numbered) == [(i + 1, i) for i in range(1500)]
    want, last = {}, {}
    for line in lines:
        want.setdefault(line[:3], int(line[4:9]))
        last[line[:3]] = int(line[4:9])
    for parts in (1, 13):
        first = first_per_key(rows.repartition(parts), "KEY", [RD.SEQ])
        assert {r.KEY: r.NO for r in first.collect()} == want
    assert {r.KEY: r.NO for r in first_record(rows, "KEY").collect()} == want
    # Without a sequence the smallest by content counts, which the function's name for order says.
    assert "_seq" not in first_record(rows.drop(RD.SEQ), "KEY").columns


def test_first_per_key_needs_an_order(spark):
    with pytest.raises(TypeError):
        first_per_key(spark.range(3), "id")


def test_delimited_sequence(spark, small_splits, tmp_path):
    write_text(f"{tmp_path}/c", "part-00000.csv", [f'"{i % 7}";"{i}"' for i in range(900)])
    rows = RD.read_delimited(spark, f"{tmp_path}/c", ["K", "V"], sequence=RD.SEQ)
    assert {r.K: r.V for r in first_per_key(rows, "K", [RD.SEQ]).collect()} == {str(i): str(i) for i in range(7)}


PACKED = Layout.of([("TYPE", 1, 2, "p"), ("TEXT", 4, 8), ("AMOUNT", 14, 5, "p", 2), ("BIG", 20, 12, "p", 1), ("DAY", 33, 10, "d")], lrecl=45)


def packed_rows(spark, n):
    return spark.range(0, n, 1, 5).select(
        (F.col("id") % 4).alias("TYPE"), F.concat(F.lit("ré"), F.col("id").cast("string")).alias("TEXT"),
        F.when(F.col("id") % 10 != 3, (F.col("id") - 50) / 100).cast("decimal(10,2)").alias("AMOUNT"),
        (F.col("id").cast("decimal(38,0)") * F.lit(10 ** 14) + F.lit(1)).alias("BIG"),
        F.date_add(F.lit("2020-01-31").cast("date"), F.col("id").cast("int") % 100).alias("DAY"))


def test_binary_records_come_back(spark, tmp_path):
    path = f"{tmp_path}/bin"
    df = packed_rows(spark, 700)
    W.write_records(df.select(binary_record(PACKED).alias("value")), path)
    got = RD.read_fixed_binary(spark, path, 45, PACKED, sequence="_seq", split=45 * 31)
    assert got.rdd.getNumPartitions() > 20
    rows = sorted(got.collect(), key=lambda r: r._seq)
    want = df.collect()
    assert [(r.TYPE, r.TEXT, r.DAY) for r in rows] == [(w.TYPE, w.TEXT, w.DAY) for w in want]
    # A missing packed number is written as positive zero.
    assert [r.AMOUNT for r in rows] == [w.AMOUNT if w.AMOUNT is not None else 0 for w in want]
    assert [r.BIG for r in rows] == [w.BIG for w in want]
    assert RD.record_numbers(got).where("line_no <= 3").count() == 3


def test_record_type_test_in_the_reader(spark, tmp_path):
    path = f"{tmp_path}/bin"
    df = packed_rows(spark, 400)
    # Records of another type hold no packed number where the others do.
    bad = F.when(F.col("TYPE") == 3, F.unhex(F.lit("FFFFFFFFFF")))
    value = binary_record(PACKED)
    record = F.when(F.col("TYPE") == 3, F.concat(F.substring(value, 1, 13), bad, F.substring(value, 19, 27))).otherwise(value)
    W.write_records(df.select(record.alias("value")), path)
    got = RD.read_fixed_binary(spark, path, 45, PACKED, columns=["AMOUNT"], where={"TYPE": [1, 2]})
    assert got.columns == ["AMOUNT"]
    assert got.count() == 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan records" in plan and "RDD" not in plan and "BIG" not in plan and "TYPE" not in plan
    every = RD.read_fixed_binary(spark, path, 45, PACKED, columns=["AMOUNT", "TYPE"]).collect()
    assert len(every) == 400 and all((r.AMOUNT is None) == (r.TYPE == 3) for r in every)


def test_cut_record_file_is_an_error(spark, tmp_path):
    with open(f"{tmp_path}/f", "wb") as f:
        f.write(b"x" * 46)
    with pytest.raises(Exception, match="no whole records"):
        RD.read_fixed_binary(spark, f"{tmp_path}/f", 45, PACKED).collect()


def test_packed_overflow_is_an_error(spark, tmp_path):
    df = spark.range(3).select((F.col("id") * 10000).alias("TYPE"))
    with pytest.raises(Exception, match="does not fit"):
        W.write_records(df.select(binary_record(Layout.of([("TYPE", 1, 2, "p")])).alias("value")), f"{tmp_path}/x")
    # Nothing was published: a folder without a manifest and without whole parts.
    assert not os.path.exists(f"{tmp_path}/x/_manifest.json")


def test_parts_of_repeated_tasks_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/bin"
    W.write_records(packed_rows(spark, 50).select(binary_record(PACKED).alias("value")), path)
    one = next(n for n in sorted(os.listdir(path)) if n.startswith("part-"))
    with open(f"{path}/{one}", "rb") as f, open(f"{path}/{one}-again", "wb") as g:
        g.write(f.read())
    assert RD.read_fixed_binary(spark, path, 45, PACKED).count() == 50
    # A rerun replaces what was there.
    W.write_records(packed_rows(spark, 20).select(binary_record(PACKED).alias("value")), path)
    assert RD.read_fixed_binary(spark, path, 45, PACKED).count() == 20


def lines_of(gen, name, back=0):
    return [r.value for r in sorted(gen.lines(name, back).collect(), key=lambda r: r.line_no)]


def numbers(spark, values):
    return spark.createDataFrame([(v, f"{v:06d}") for v in values], "k int, value string").repartition(4)


def test_generation_in_order(spark, small_splits, tmp_path):
    gen = Generations(spark, f"{tmp_path}/out")
    gen.publish({"n": (numbers(spark, range(3000)), ["k"])})
    parts = gen.manifest()["outputs"]["n"]
    assert len(parts) > 1 and sum(p["records"] for p in parts) == 3000
    assert all(a["last"] < b["first"] for a, b in zip(parts, parts[1:]))
    # The parts, one after the other, are the file.
    text = "".join(open(f"{p['path']}/{p['file']}").read() for p in parts)
    assert text.split() == [f"{k:06d}" for k in range(3000)] == lines_of(gen, "n")


def test_failing_output_leaves_the_old_generation(spark, tmp_path):
    gen = Generations(spark, f"{tmp_path}/out")
    gen.publish({"a": (numbers(spark, [1, 2]), ["k"]), "b": (numbers(spark, [3]), ["k"])})
    bad = numbers(spark, range(10)).withColumn("value", F.when(F.col("k") == 7, F.raise_error(F.lit("boom"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="boom"):
        gen.publish({"a": (numbers(spark, [5]), ["k"]), "b": (bad, ["k"])})
    assert gen.numbers() == [1]
    assert (lines_of(gen, "a"), lines_of(gen, "b")) == (["000001", "000002"], ["000003"])
    assert len(os.listdir(f"{tmp_path}/out/data")) == 1


def test_generations_replace_and_roll_off(spark, tmp_path):
    gen = Generations(spark, f"{tmp_path}/out", keep=2)
    for n in (1, 2, 3):
        assert gen.publish({"a": (numbers(spark, [n]), ["k"])}) == n
    assert gen.numbers() == [2, 3]
    gen.publish({"a": (numbers(spark, [9, 8]), ["k"])}, generation=2)
    assert gen.numbers() == [2, 3]
    assert (lines_of(gen, "a"), lines_of(gen, "a", back=1)) == (["000003"], ["000008", "000009"])
    assert len(os.listdir(f"{tmp_path}/out/data")) == 2
    with pytest.raises(LookupError):
        gen.read("a", back=2)
    gen.publish({"a": (numbers(spark, [1]).limit(0), ["k"])})
    assert lines_of(gen, "a") == []


def test_published_number_is_not_taken_twice(spark, tmp_path):
    gen = Generations(spark, f"{tmp_path}/out")
    gen.publish({"a": (numbers(spark, [1]), ["k"])})
    with pytest.raises(Exception):
        gen._put(gen._path(1), "{}", replace=False)
    assert lines_of(gen, "a") == ["000001"]


def test_outputs_of_one_frame_compute_it_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    frame = numbers(spark, range(100)).mapInArrow(count, "k int, value string")
    Generations(spark, f"{tmp_path}/out").publish_from(frame, {
        "up": lambda f: (f, ["k"]), "odd": lambda f: (f.where("k % 2 = 1"), ["k"])})
    assert seen.value == 100


# ------------------------------------------------------------ positional merges
def sides(spark, seed, n=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        rows = [(rng.choice([None, "a", "b", "c", "hot", "hot"]), j, f"{i}:{j}") for j in range(rng.randrange(60))]
        out.append((rows, spark.createDataFrame(rows, f"K string, n{i} int, v{i} string")))
    return out


def brute(rows):
    """Sequential merge of lists of (key, order, value)."""
    groups = [{} for _ in rows]
    for g, side in zip(groups, rows):
        for r in sorted(side, key=lambda r: r[1]):
            g.setdefault(r[0], []).append(r[1:])
    out = []
    for key in groups[0]:
        for slot in range(max(len(g.get(key, [])) for g in groups)):
            row = [key]
            for g in groups:
                have = g.get(key)
                row += list(have[min(slot, len(have) - 1)]) if have else [None, None]
            out.append((*row, slot + 1))
    return sorted(out, key=repr)


@pytest.mark.parametrize("way", [True, False, None])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_files_as_sequential(spark, seed, way, monkeypatch):
    monkeypatch.setattr(JN, "HOT_ROWS", 15)
    monkeypatch.setattr(JN, "SAMPLE", 1)
    made = sides(spark, seed)
    got = JN.merge_files([df for _, df in made], "K", [["n0"], ["n1"], ["n2"]], skew_safe=way)
    assert sorted(map(tuple, got.collect()), key=repr) == brute([r for r, _ in made])


def test_merge_files_as_merges_in_sequence(spark):
    made = sides(spark, 7)
    a, b, c = [df for _, df in made]
    one = JN.match_merge(a, b, "K", ["n0"], ["n1"]).drop("in_left", "in_right").withColumnRenamed("slot", "s1")
    two = JN.match_merge(one, c, "K", ["s1"], ["n2"]).drop("in_left", "in_right", "s1")
    got = JN.merge_files([a, b, c], "K", [["n0"], ["n1"], ["n2"]])
    assert sorted(map(tuple, got.select(*two.columns).collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)


def test_hot_keys_are_found(spark):
    df = spark.range(40000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("K"))
    assert JN.hot_keys([df, df], ["K"], rows=20000, share=0.1) == [(-1,)]
    assert JN.hot_keys([df], ["K"], rows=20000, share=0.1) == []


def test_one_exchange_for_four_files(spark):
    """All files are dealt out by key once."""
    frames = [spark.range(50).select((F.col("id") % 5).alias("K"), F.col("id").alias(f"v{i}")) for i in range(4)]
    merged = JN.merge_files(frames, "K", [[f"v{i}"] for i in range(4)])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_files_may_not_share_columns(spark):
    with pytest.raises(ValueError):
        JN.merge_files([spark.range(2).withColumn("x", F.lit(1))] * 2, "id", [[], []])


def test_rows_are_rendered_as_they_are_published(spark, tmp_path):
    """an output may be given as narrow rows with their rendering; its parts are compressed."""
    gen = Generations(spark, f"{tmp_path}/out", compression="gzip")
    rows = spark.range(3000).select((F.lit(2999) - F.col("id")).alias("k")).repartition(4)
    gen.publish({"n": (rows, ["k"], F.rpad(F.lpad(F.col("k").cast("string"), 6, "0"), 150, " "))})
    parts = gen.manifest()["outputs"]["n"]
    assert [v for v in lines_of(gen, "n")] == [f"{i:06d}".ljust(150) for i in range(3000)]
    assert sum(p["records"] for p in parts) == 3000
    assert parts[0]["first"] == "000000".ljust(150) and parts[-1]["last"] == "002999".ljust(150)
    assert sum(os.path.getsize(f"{p['path']}/{p['file']}".removeprefix("file:")) for p in parts) < 3000 * 151 / 4


def test_inputs_are_written_in_files_of_bounded_size(spark, monkeypatch):
    """more records make more files, and their order stays."""
    from recsmith.catalog import files as CF

    monkeypatch.setattr(CF, "FILE_BYTES", 4000)
    layout = Layout.of([("k", 1, 8, "z")], lrecl=100)
    path = CF.put(spark.range(2000).select((F.col("id") * 7 % 2000).alias("k")), layout, ["k DESC"])
    rows = RD.record_numbers(RD.read_fixed_text(spark, path, layout, sequence=RD.SEQ))
    assert [r.k for r in rows.orderBy("line_no").collect()] == list(range(1999, -1, -1))
    assert rows.select(F.countDistinct(F.col(RD.SEQ)["file"])).first()[0] > 30


def test_missing_and_varied_binary_records_are_written(spark, tmp_path):
    """Records go out as they stand in their column; missing ones are nothing."""
    df = spark.range(0, 900, numPartitions=3).select(
        F.when(F.col("id") % 3 > 0, F.lpad(F.col("id").cast("string"), 5, "0").cast("binary")).alias("value"))
    W.write_records(df, f"{tmp_path}/x")
    files = [f for f in sorted(os.listdir(f"{tmp_path}/x")) if f.startswith("part-")]
    data = b"".join(open(f"{tmp_path}/x/{f}", "rb").read() for f in files)
    assert data == b"".join(b"%05d" % i for i in range(900) if i % 3)


def test_owner_edges_are_deduplicated_before_they_are_flipped(spark):
    """one row per edge whichever way it was stored, and the same pairs come out of it."""
    from recsmith.plans import owners as OW

    names = ["1", "2", "2  ", "12345678901", "123456789012", "123456789013", "", None]
    edges = [(a, c, b, d) for a in names for b in names for c, d in [("A", "B"), ("B", "A"), (None, "A"), ("A", "A"), ("ABCD", "ABCE")]]
    rel = spark.createDataFrame(edges * 2, "CUST1 string, CODE1 string, CUST2 string, CODE2 string")
    cut = lambda v, n: (v or "")[:n].rstrip(" ")
    both = edges + [(b, d, a, c) for a, c, b, d in edges]
    want = {(a.rstrip(" "), cut(c, 3), cut(b, 11), cut(d, 3)) for a, c, b, d in both if a is not None and len(a.rstrip(" ")) <= 11}
    got = [tuple(r) for r in OW.both_directions(OW.distinct_edges(rel)).select("CUSTNO", "CODE1", "CUSTNO2", "CODE2").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert OW.distinct_edges(rel).count() < len(want)


def test_lines_are_read_without_making_names_of_every_line(spark, tmp_path):
    """Parts of ten thousand and more, several splits a part, parts beside each other in a task: numbers
    follow the parts' numbers; part names are taken apart once a split."""
    gen = Generations(spark, f"{tmp_path}/g")
    gen.publish({"n": (spark.range(40).select(F.format_string("%06d", "id").alias("value")), ["value"])})
    path, manifest = gen._path(1), gen.manifest()
    parts, folder = manifest["outputs"]["n"], manifest["outputs"]["n"][0]["path"]
    assert sum(p["records"] for p in parts) == 40 and all(p["first"] <= p["last"] for p in parts)
    # Two parts that sort the other way round as text, the later one in several splits.
    names = ["part-99999-x.txt", "part-100000-x.txt"]
    for name, numbers in zip(names, (range(3), range(3, 5000))):
        with open(f"{folder}/{name}", "w") as f:
            f.writelines(f"{k:06d}\n" for k in numbers)
    manifest["outputs"]["n"] = [{**parts[0], "file": n} for n in names]
    gen._put(path, json.dumps(manifest), replace=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        out = gen.lines("n")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert [(r.line_no, r.value) for r in sorted(out.collect())] == [(k + 1, f"{k:06d}") for k in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # The stored lines carry no made-up name.
    assert "_seq" not in plan


def test_owner_file_sorts_stored_columns(spark, tmp_path, monkeypatch):
    """Nothing is rendered anew to be sampled, dealt out and compared."""
    given = []
    monkeypatch.setattr(Generations, "publish", lambda self, outputs: given.append(outputs["owners"]) or 1)
    for name, text in (("a", "01000000001 00000000007 ABC901\n"), ("r", "00000000007".ljust(20) + "X  " + "00000000008".ljust(20) + "Y  \n")):
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write(text)
    assert FJ.owners_job(spark, f"{tmp_path}/a", f"{tmp_path}/r", Generations(spark, f"{tmp_path}/g")) == 1
    rows, order, value = given[0]
    assert all(isinstance(o, str) and o in rows.columns for o in order) and set(order) == set(rows.columns)
    assert {r.value for r in rows.select(value.alias("value")).collect()} == {
        ("DP".ljust(5) + "01000000001".ljust(20) + "ABC" + "00000000007" + "X  " + "00000000008" + "Y  ").ljust(150)}


def test_compressed_records_read_the_same(spark, tmp_path):
    """Rows, sequence and record-type test are those of plain parts, in far less room; a part is one split."""
    df = packed_rows(spark, 5000).repartition(3).select(binary_record(PACKED).alias("value"))
    df = spark.createDataFrame(df.collect(), "value binary").coalesce(3)
    found, room = [], []
    for compressed in (False, True):
        path = f"{tmp_path}/{compressed}"
        W.write_records(df, path, compressed=compressed)
        read = RD.read_fixed_binary(spark, path, PACKED.lrecl, PACKED, sequence=RD.SEQ, split=2000)
        rows = sorted(read.collect(), key=lambda r: r[RD.SEQ])
        found.append([tuple(x for n, x in r.asDict().items() if n != RD.SEQ) for r in rows])
        parts = json.load(open(f"{path}/_manifest.json"))["parts"]
        room.append(sum(os.path.getsize(f"{path}/{p['file']}") for p in parts))
        assert sum(p["bytes"] for p in parts) == 5000 * PACKED.lrecl
        assert not compressed or read.rdd.getNumPartitions() == len([p for p in parts if p["bytes"]])
    assert found[0] == found[1] and len(found[0]) == 5000 and room[1] < room[0]
