"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random

import pytest

CLASHING = ["id", "digest", "row", "hash", "size", "fp", "key", "mark", "starts", "item", "bin", "part", "after", "n", "s", "word"]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(1, 7))) for _ in range(n)]
    for k in range(7, n, 9):
        words[k] += draw.choice([".", ",", "\n", " |"])
    return " ".join(words)


def edge_rows():
    long = prose(1, 6000)
    shared = prose(2, 60)
    texts = [
        None, "", " \t\n ", "Hello, World", "hello,  world", "Hello, World", long, long, long.replace(" ", "  "),
        prose(3, 50) + " " + shared + " " + prose(4, 50), shared, prose(5, 30) + " " + shared, "12345 -- !!", "ß é 漢字 кириллица",
        "All rights reserved. CC-BY cc by", "Licensed under the Apache License, Version 2.0 (the \"License\")", "\x1e\x1f   áb",
        "the the the the " * 30, prose(6, 400), prose(6, 399) + " changed", "<|endoftext|> it's 2nd", "one", "one two",
    ]
    rows = [(k, t, ["en", "de", None][k % 3], ["b", "a", None, "Z"][k % 4]) for k, t in enumerate(texts)]
    rows += [(3, "Hello, World", "en", "a"), (3, "Hello, World", "en", "a"), (None, "null id", "en", "b"), (None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("edges")
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(edge_rows(), schema)
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    docs.coalesce(2).write.parquet(f"{path}/documents.parquet")
    html = [(k, f"http://h/{k}", t) for k, t, _, _ in edge_rows()] + [(99, None, "no uri"), (-5, "http://h/ space", "no uri")]
    spark.createDataFrame(html, "page_id long, url string, html string").selectExpr("*", "'x' AS id", "'y' AS payload").write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(edge_vectors(), "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "'x' AS id", "'y' AS q", "1 AS code", "2 AS n", "3 AS slot", "4 AS score", "5 AS anchor"
    ).coalesce(2).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def edge_vectors():
    """Nulls in every column, unusable vectors, ties, repeated rows and ids, one vector on a third of the rows."""
    draw = random.Random(9)
    vector = lambda: [draw.gauss(0, 0.1) for _ in range(32)]
    hot = vector()
    rows = [(k, hot if k % 3 == 0 else vector(), draw.choice([0, 1, 1, 1, 2, None])) for k in range(160)]
    rows += [(50, vector(), 1), (50, hot, 1), (50, hot, 1), (100, hot, 1), (None, hot, 1), (None, vector(), 2), (None, None, None)]
    rows += [(200, None, 1), (201, [], 1), (202, [1.0], 1), (203, [*hot[:31], None], 1), (204, [*hot[:31], float("nan")], 1),
             (250, [*hot[:31], float("-inf")], 1), (-50, [-x for x in hot], 1), (300, [0.0] * 32, 1), (350, vector(), 77)]
    return rows


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for name in ("documents", "pages", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").where("false").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def read(spark, sf_dir, table="documents"):
    return [tuple(r)[:4] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()]
