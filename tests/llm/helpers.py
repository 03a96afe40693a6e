"""Small tables with the awkward cases, and plain versions of what the operators compute."""

import random

from pyspark.sql import types as T

SCHEMA = "doc_id long, text string"
WORDS = "the of and un de la que der und die haus river stone light été señal über naïve".split()


def prose(seed, words, lines=1):
    r = random.Random(seed)
    out = [" ".join(r.choice(WORDS) + str(r.randrange(40)) * (r.random() < 0.6) for _ in range(max(1, words // lines))) for _ in range(lines)]
    return "\n".join(out)


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, white space of all kinds."""
    base = prose(1, 120, 8)
    words = base.split(" ")
    near = " ".join(["changed", *words[1:]])
    return [
        (1, base),
        (2, base),
        (2, base),
        (3, near),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "two words"),
        (8, "two words"),
        (None, base),
        (None, None),
        (9, prose(2, 9000, 300)),
        (10, "A  b c 　 d\r\n日本語 \U0001f600 <|endoftext|> x"),
        (11, base.replace("\n", " \n")),
        (12, "one " * 80),
        (13, prose(3, 200, 10) + "\n" + base),
        (14, base + "\n" + prose(4, 200, 10)),
        (15, prose(5, 60)),
    ]


def frame(spark, rows=None, extra=False):
    df = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA).repartition(3)
    if extra:
        names = "n kind kept start length token place level digest h1 h2 chunk word row_id score ids first_id bucket payload sequence_id offset chunks_removed rep component node".split()
        df = df.selectExpr("*", *(f"'x' AS {c}" for c in names), "CAST(NULL AS STRING) AS lang")
    return df


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, T._parse_datatype_string(schema))
