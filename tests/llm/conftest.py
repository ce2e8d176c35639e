import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(autouse=True)
def small_data_settings(spark):
    """Compiling a stage takes longer than running it on tables this small."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "3"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau phi".split()


def prose(seed: int, n: int) -> str:
    """Text of ``n`` words without repeats of four words in a row."""
    return " ".join(f"{WORDS[(seed * 7 + i * i + i) % 20]}{(seed * 31 + i) % 97}" for i in range(n))


def edge_documents() -> list:
    """(doc_id, text, lang, source, n_chars) with nulls, ties, repeats, empty and long texts."""
    base, long = prose(1, 120), "\n".join(prose(s, 60) for s in range(3, 400))
    near = base.replace("beta", "beta", 1) + " tail"
    return [
        (0, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, near, None, "a", None),
        (3, None, "en", None, None),
        (4, "", None, "b", 0),
        (5, " \t\n\x0b\x0c\r ", "de", "b", 7),
        (6, "One two", "en", "b", 7),
        (7, "one TWO", "en", "", 7),
        (8, long, "en", "c", 9),
        (9, long + " " + base, "fr", "c", 9),
        (10, "é" * 120 + "mañana " + "ü" * 130 + " " + "é" * 120, "es", "d", 9),
        (11, "aaaa " * 200, "en", "d", 9),
        (12, "x" * 5000, None, None, 9),
        (13, "mail me: a.b+c@ex-ample.co.uk or +1 (499) 555-6503, 4111 1111 1111 1111; 256.1.1.1 10.0.0.1 a@b.c%d@e.f", "en", "e", 9),
        (14, "1 " * 40 + "12--34 5500-0000-0000-0004 +1-2-3 1.2.3.4.5.6.7.8 00010.0.0.255", "en", "e", 9),
        (15, "<|endoftext|> a  b\n\n c  d e <|im_end|>   tail \n x", "en", "e", 9),
        (16, "shared line that stands in several documents\n" * 3 + prose(5, 30), "en", "a", 9),
        (17, "shared line that stands in several documents\n" * 2 + prose(6, 30), "en", "a", 9),
        (None, prose(7, 40), "en", "a", 9),
        (20, "\n".join(prose(s, 9) for s in range(8)) + "\n\n  ", "en", "a", None),
    ]


SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def edge_vectors() -> list:
    """(vec_id, embedding, label): groups of copies, ties, repeated rows, and rows that take no part."""
    vectors = [(i, [float(i % 7), float(i % 5) - 2, 1.0, float(i % 3)], 0) for i in range(61)]
    copies = [(i, [2.0, 2.0, 2.0, 2.0], 1) for i in range(100, 180)]
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan"), 1.0, 1.0, 1.0], [float("inf"), 0.0, 0.0, 1.0], [1.0, 2.0]]
    return [
        *vectors, *copies, *[(200 + 20 * k, v, 2) for k, v in enumerate(odd)],
        (40, vectors[40][1], 0), (40, [5.0, 1.0, -1.0, 0.5], 0), (None, [3.0, 3.0, 3.0, 3.0], None), (-20, [-1.0, 0.0, 0.0, -0.0], 3),
    ]


def edge_tables() -> dict:
    quoted = prose(1, 120).split()
    return {
        "documents": edge_documents(),
        "benchmark": [
            (1, " ".join(quoted[10:30]).upper()),
            (2, "one, TWO"),
            (3, None),
            (4, "?!"),
            (5, " ".join(quoted[15:40])),
            (10, "one two"),
        ],
        "labels": [(0, 1, 0), (1, 1, None), (11, 0, 1), (None, 1, 1), (8, None, 0), (8, 1, 0), (99, 1, 1)],
        "conversations": [
            (1, 0, "user", "hi | there \\ <|im_end|>"),
            (1, 1, "assistant", "a\nb\\p|<|im_start|>user x"),
            (1, 1, "assistant", "a second turn one"),
            (2, None, None, None),
            (2, 3, "assistant", ""),
            (None, 0, "user\nassistant", "odd"),
            *[(3, 0, "user", t) for t in ("x y", "x")],
            *[(4, 0, "user", t) for t in ("aa", "a|", "a\\\\p", "a\\|", "a\n")],
            *[(5, 0, "user", t) for t in ("1", None)],
            *[(6, 0, r, "t") for r in ("b", "b\n", "b|", "b\\n", "bb")],
        ],
        "embeddings": edge_vectors(),
    }


@pytest.fixture(scope="session")
def write_tables(spark, tmp_path_factory):
    """Writes tables to a new folder and gives its path; ``extra`` adds clashing columns."""

    def write(tables: dict, extra: str = "") -> str:
        folder = tmp_path_factory.mktemp("tables")
        for name, schema in SCHEMAS.items():
            df = spark.createDataFrame(tables.get(name, []), schema)
            if extra and name == "documents":
                df = df.selectExpr("*", extra)
            df.coalesce(2).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write


@pytest.fixture(scope="session")
def edge_dir(write_tables):
    return write_tables(edge_tables())


@pytest.fixture(scope="session")
def empty_dir(write_tables):
    return write_tables({})
