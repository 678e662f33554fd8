import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
# columns whose names the operators use inside
CLASHING = ["host", "size", "node", "bucket", "score", "start", "words", "kept", "ids", "component_id", "h1", "nth"]


def words(rng, n, vocabulary=400):
    return [letters(rng.randrange(vocabulary)) for _ in range(n)]


def letters(number):
    """A word for a number: lines are compared without their digits."""
    return "w" + "".join("abcdefghij"[int(d)] for d in str(number))


def sample_rows():
    """Invented documents: plain, copies, near copies, repeated lines, empty, null, long, repeated rows."""
    rng, rows = random.Random(5), []
    for i in range(40):
        lines = [" ".join(words(rng, rng.randrange(6, 30))).capitalize() + "." for _ in range(rng.randrange(1, 6))]
        rows.append((i, "\n".join(lines), ("en", "fr")[i % 2], ("a", "b", None)[i % 3], 1))
    base = rows[3][1]
    changed = base.split(" ")
    changed[len(changed) // 2] = "changed"
    shared_line = " ".join(words(rng, 12))
    rows += [
        (40, base, "en", "a", 1),  # an exact copy
        (41, " ".join(changed), "en", "a", 1),  # a near copy
        (42, None, None, None, None),
        (43, "", "fr", "b", 0),
        (44, " \n\t ", "fr", "b", 3),
        (45, "### 123 $$$", "fr", "b", 3),
        (46, "one", "en", "zz", 3),
        (47, " ".join(words(rng, 30000, 3000)), "en", "a", 3),  # a long text
        (48, shared_line + "\nown words of this one document here", "en", "b", 3),
        (49, "something else stands here first of all\n" + shared_line.upper() + "!\nlast", "en", "b", 3),
        (50, "x y " * 60, "en", "b", 3),  # repeats itself
        (51, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich\r\n" * 2, "fr", "b", 3),
        (52, rows[7][1], "en", "a", 3),
        (52, rows[7][1], "en", "a", 3),  # a repeated row
        (None, "a row without an id has some words as well", "en", "a", 3),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def clashing(spark, docs):
    """The same documents with columns of names that the operators use themselves."""
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("clash") for name in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
