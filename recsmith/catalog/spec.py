"""Fixed values of the job specifications for the SQL twins: record positions
(name, first byte, width), headings and rule tables, written out here so that
a twin shares nothing with the code under test."""

# Relationship search record; EXPDATE is printed as yyyy-mm-dd.
BOTH = [("CUSTNO1", 1, 11), ("INDORG1", 15, 1), ("CODE1", 20, 3), ("DESC1", 25, 15), ("CUSTNO2", 40, 11), ("INDORG2", 55, 1),
        ("CODE2", 60, 3), ("DESC2", 65, 15), ("EXPDATE", 80, 10), ("CUSTNAME1", 95, 40), ("ALIAS1", 135, 20),
        ("CUSTNAME2", 155, 40), ("ALIAS2", 195, 20), ("OLDIC1", 215, 9), ("BASICGRPCODE1", 225, 3), ("OLDIC2", 228, 9),
        ("BASICGRPCODE2", 238, 3), ("EFFDATE", 242, 8)]
SIDES = {"CUSTNO1": "CUSTNO2", "INDORG1": "INDORG2", "CODE1": "CODE2", "DESC1": "DESC2", "CUSTNAME1": "CUSTNAME2",
         "ALIAS1": "ALIAS2", "OLDIC1": "OLDIC2", "BASICGRPCODE1": "BASICGRPCODE2"}

# Parties with accounts: fixed record, and the quoted one (where the byte after
# the tenth of CUSTNO1 holds the separator).
PARTY = [("CUSTNO1", 1, 11), ("CUSTTYPE1", 15, 1), ("RLENCODE1", 20, 3), ("DESC1", 25, 15), ("CUSTNO", 40, 11),
         ("CUSTTYPE", 55, 1), ("RLENCODE", 60, 3), ("DESC", 65, 15), ("ACCTCODE", 80, 5), ("ACCTNO", 85, 20),
         ("CUSTNAME1", 105, 40), ("ALIAS1", 145, 20), ("CUSTNAME", 165, 40), ("ALIAS", 205, 20)]
PARTY_QUOTED = [("CUSTNO1", 2, 10), ("CUSTTYPE1", 15, 1), ("RLENCODE1", 19, 3), ("DESC1", 25, 15), ("CUSTNO", 43, 11),
                ("CUSTTYPE", 57, 1), ("RLENCODE", 61, 3), ("DESC", 67, 15), ("ACCTCODE", 85, 5), ("ACCTNO", 93, 20),
                ("CUSTNAME1", 116, 40), ("ALIAS1", 159, 20), ("CUSTNAME", 182, 40), ("ALIAS", 225, 20)]

# Address repair: update record, verify report and its heading.
UPDATE = [("CUSTNO", 1, 11), ("ADDREF", 12, 11), ("NEW_CITY", 23, 25), ("STATEX", 48, 3), ("NEW_ZIP", 51, 5),
          ("NEW_COUNTRY", 56, 10)]
VERIFY = [("CUSTNO", 1, 11), ("DASH", 12, 1), ("ADDREF", 13, 11), ("LINE1ADR", 25, 40), ("LINE2ADR", 66, 40),
          ("LINE3ADR", 107, 40), ("LINE4ADR", 148, 40), ("LINE5ADR", 189, 40), ("OLD", 230, 5), ("ZIP", 236, 5),
          ("CITY", 241, 25), ("COUNTRY", 267, 10), ("NEW", 279, 5), ("NEW_ZIP", 285, 5), ("NEW_CITY", 291, 25),
          ("STATEX", 317, 3), ("NEW_COUNTRY", 321, 10)]
VERIFY_HEADING = [("CIS #", 1), ("-", 12), ("ADDR REF", 13), ("ADDLINE1", 25), ("ADDLINE2", 66), ("ADDLINE3", 107),
                  ("ADDLINE4", 148), ("ADDLINE5", 189), ("ZIP", 236), ("CITY", 241), ("COUNTRY", 267), ("ZIP", 285),
                  ("CITY", 291), ("COUNTRY", 317)]

# Account ranges (open) and zip ranges (closed); a later line wins.
DEPOSITS = [("03000000000", "03999999999", "CA"), ("06200000000", "06299999999", "CA"), ("06710000000", "06719999999", "CA"),
            ("01000000000", "01999999999", "FD"), ("07000000000", "07999999999", "FD"), ("04000000000", "04999999999", "SA"),
            ("05000000000", "05999999999", "SA"), ("06000000000", "06199999999", "SA"), ("06300000000", "06709999999", "SA"),
            ("06720000000", "06999999999", "SA")]
LOANS = [("02000000000", "02999999999", "LN"), ("08000000000", "08999999999", "HP")]
ZIP_STATES = [(79000, 86999, "JOH"), (5000, 9999, "KED"), (15000, 18999, "KEL"), (75000, 78999, "MEL"), (70000, 73999, "NEG"),
              (25000, 28999, "PAH"), (69000, 69000, "PAH"), (10000, 14999, "PEN"), (30000, 36999, "PRK"), (39000, 39999, "PRK"),
              (1000, 2999, "PER"), (88000, 91999, "SAB"), (93000, 98999, "SAR"), (40000, 49999, "SEL"), (63000, 64999, "SEL"),
              (68000, 68199, "SEL"), (20000, 24999, "TER"), (50000, 60999, "W P"), (87000, 87999, "LAB"), (62000, 62999, "PUT")]

# Customer report: heading, first byte, field, width, decimals of a number (None:
# text), byte of the separator.
REPORT = [
    ("ID TYPE", 7, "ALIASKEY", 5, None, 15), ("ID NUMBER", 16, "ALIAS", 20, None, 37), ("CUST NAME", 38, "CUSTNAME", 40, None, 79),
    ("CIS NUMBER", 80, "CUSTNO", 11, None, 92), ("OCCUPATION", 93, "DEMODESC", 60, None, 154),
    ("MASCO", 155, "MASCODESC", 27, None, 183), ("SIC CODE", 184, "SICCODE", 5, None, 193),
    ("MSIC BIS TYPE", 194, "MSICDESC", 27, None, 222), ("ACCT NUMBER", 223, "ACCTNOC", 20, None, 244),
    ("ACCT BRANCH", 245, "BRANCH_ABBR", 5, None, 257), ("ACCT STATUS", 258, "ACCTSTATUS", 24, None, 283),
    ("DATE ACCT OPEN", 284, "DATEOPEN", 8, None, 301), ("DATE ACCT CLOSED", 302, "DATECLSE", 8, None, 320),
    ("SDB(YES/NO)", 321, "SDBIND", 3, None, 333), ("BR SDB MAINTAN", 334, "SDBBRH", 3, None, 348),
    ("CURRENT BALANCE", 349, "TEMP_CURBAL", 14, 2, 364), ("CURR CYC DR", 365, "TEMP_CURR_CYC_DR", 10, 0, 376),
    ("CURR AMT DR", 377, "TEMP_CURR_AMT_DR", 16, 2, 394), ("CURR CYC CR", 395, "TEMP_CURR_CYC_CR", 10, 0, 406),
    ("CURR AMT CR", 407, "TEMP_CURR_AMT_CR", 16, 2, 424), ("PREV CYC DR", 425, "TEMP_PREV_CYC_DR", 10, 0, 442),
    ("PREV AMT DR", 443, "TEMP_PREV_AMT_DR", 16, 2, 460), ("PREV CYC CR", 461, "TEMP_PREV_CYC_CR", 10, 0, 478),
    ("PREV AMT CR", 479, "TEMP_PREV_AMT_CR", 16, 2, 496), ("POST INDICATOR", 497, "ACCT_PST_IND", 1, None, 511),
    ("POST INDICATOR REASON", 512, "ACCT_PST_REASON", 20, None, 533), ("TOTAL OF HOLD", 534, "TOT_HOLD", 2, None, 547),
    ("SEQ OF HOLD(1)", 548, "SEQID_1", 2, None, 562), ("AMT OF HOLD(1)", 563, "TEMP_AMT_1", 14, 2, 579),
    ("DESCRIP OF HOLD(1)", 580, "DESC_1", 20, None, 600), ("SOURCE(1)", 601, "SOURCE_1", 20, None, 621),
    ("SEQ OF HOLD(2)", 622, "SEQID_2", 2, None, 636), ("AMT OF HOLD(2)", 637, "TEMP_AMT_2", 14, 2, 653),
    ("DESCRIP OF HOLD(2)", 654, "DESC_2", 20, None, 674), ("SOURCE(2)", 675, "SOURCE_2", 20, None, 695),
    ("SEQ OF HOLD(3)", 696, "SEQID_3", 2, None, 700), ("AMT OF HOLD(3)", 701, "TEMP_AMT_3", 14, 2, 717),
    ("DESCRIP OF HOLD(3)", 718, "DESC_3", 20, None, 738), ("SOURCE(3)", 739, "SOURCE_3", 20, None, 759)]
RAW = [("CUSTNO", 1, 11), ("ACCTNOC", 14, 20), ("OCCUP", 36, 3), ("MASCO2008", 42, 5), ("ALIASKEY", 50, 5), ("ALIAS", 56, 20),
       ("CUSTNAME", 78, 40), ("DATEOPEN", 120, 8), ("DATECLSE", 130, 8), ("LEDGERBAL", 140, 12), ("BANKINDC", 152, 1),
       ("CITIZENSHIP", 154, 2), ("APPL_CODE", 158, 5), ("PRODTY", 164, 3), ("DEMODESC", 169, 60), ("MASCODESC", 231, 27),
       ("JOINTACC", 260, 1), ("MSICCODE", 262, 5), ("ACCTBRCH", 267, 3), ("BRANCH_ABBR", 275, 5), ("ACCTSTATUS", 280, 24),
       ("SICCODE", 304, 5)]

# Address repair: countries that drop an address, as the specification lists them.
COUNTRIES = [
    "SINGAPORE", "CANADA", "SINGAPORE`",
    "LONDON", "AUS", "AUSTRIA",
    "BAHRAIN", "BANGLADESH", "BRUNEI DAR",
    "CAMBODIA", "CAN", "CAYMAN ISL",
    "CHINA", "BRUNEI", "INDONESIA",
    "DARUSSALAM", "DENMARK", "EMIRATES",
    "ENGLAND", "EUROPEAN", "FRANCE",
    "GERMANY", "HONG KONG", "INDIA",
    "IRAN (ISLA", "IRELAND", "JAPAN",
    "KOREA REPU", "MACAU", "MAURITIUS",
    "MEXICO", "MYANMAR", "NEPAL",
    "NETHERLAND", "NEW ZEALAN", "NEWZEALAND",
    "NIGERIA", "NORWAY", "OMAN",
    "PAKISTAN", "PANAMA", "PHILIPPINE",
    "ROC", "S ARABIA", "SAMOA",
    "SAUDI ARAB", "SIGAPORE", "SIMGAPORE",
    "SINGAPOREW", "SINGPAORE", "SINGPORE",
    "SINAGPORE", "SNGAPORE", "SINGOPORE",
    "SPAIN", "SRI LANKA", "SWAZILAND",
    "SWEDEN", "SWITZERLAN", "TAIWAN",
    "TAIWAN,PRO", "THAILAND", "U KINGDOM",
    "U.K.", "UNITED ARA", "UK",
    "UNITED KIN", "UNITED STA", "VIRGIN ISL",
    "USA", "PAPUA NEW", "AUSTRALIA"]
# Words in the address lines that drop an address.
WORDS = [
    "SINGAPORE", "HONG HONG", "QATAR", "TAMIL NADU", "STAFFORDSHIRE", "HANOI", "VIETNAM", "NEW ZEALAND", "ENGLAND", "AUCKLAND",
    "SHANGHAI", "DOHA QATAR", "THAILAND", "HONG KONG", "SEOUL", "#", "NSW", "NETHERLANDS", "AUSTRALIA", "S'PORE"]


def overwritten(parts, width):
    """A heading whose later texts are written over earlier ones."""
    line = [" "] * width
    for text, at in parts:
        line[at - 1:at - 1 + len(text)] = text
    return "".join(line)


def heading(parts, width):
    line = ""
    for text, at in parts:
        line = line.ljust(at - 1) + text
    return line.ljust(width)
