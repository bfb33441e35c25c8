"""Small tables with the cases every operator must cope with."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.01"

LONG = " ".join(f"w{i % 977}x" for i in range(60_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the dog for a while.\nThen it went away.", "en", "a", 70),
    (2, None, "en", "a", 0),
    (3, "", None, "b", 0),
    (4, " \t\n  ", "en", None, 4),
    (None, "The cat sat on the mat and looked at the dog for a while.\nThen it went away.", "en", "a", 70),
    (None, None, None, None, None),
    (5, LONG, "en", "a", len(LONG)),
    (6, "The cat sat on the mat and looked at the dog for a while.\nThen it went away.", "en", "b", 70),
    (6, "The cat sat on the mat and looked at the dog for a while.\nThen it went away.", "en", "b", 70),
    (6, "Der Hund und die Katze saßen auf der Matte, und dann gingen sie 😀 weg.", "de", "c", 70),
    (7, "one", "de", "c", 3),
    (8, "word " * 40, "fr", "c", 200),
    (9, "▁mark  two  blanks \r\n tab\tend ", "fr", "", 30),
]


def messy(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def clashing(docs, *names):
    """The same table with more columns, named as the operators name theirs."""
    for name in names:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def rows(table):
    return sorted((tuple(row) for row in table.collect()), key=repr)
