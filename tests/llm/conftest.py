import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def hostile_rows(seed=3):
    """Nulls in every column, empty, blank and long texts, copies, repeated rows, odd characters."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocab, k=n))
    base, long_ = prose(120), prose(6000)
    edited = base.split(" ")
    edited[60] = "CHANGED"
    texts = [None, "", " \t\n", "One", "two words", base, base, base.upper(), " ".join(edited),
             long_, long_[:len(long_) // 2], "x" * 3000, "naïve café 　été 漢字 漢字 🙂🙂 it's 123\n\n  end ",
             "### User: </turn> \\# <|endoftext|>", prose(40) + "\nfooter line\n" + prose(10),
             prose(30) + "\nfooter line\n" + prose(5), "\nfooter line\n\nfooter line", prose(200), prose(200) + base]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(5, base, None, None, None), (5, base, None, None, None), (None, base, "en", "s1", 1),
             (None, None, None, None, None), (99, prose(50), None, "s0", 5), (99, prose(60), "en", None, 6)]
    return rows


@pytest.fixture(scope="session")
def hostile(spark):
    """The hostile rows with extra columns whose names clash with output columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(hostile_rows(), DOC)
    for name in ("size", "target", "copies", "score", "predicted", "ids", "decoded", "n_tokens", "n_lines",
                 "n_dropped", "held_out", "component_id", "spans", "kept", "digest", "label", "key"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
