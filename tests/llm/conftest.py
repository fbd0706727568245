"""Documents with every awkward case: nulls, empty and very long texts, repeated rows, ties, clashing column names."""

import random

import pytest

# names that the operators use inside
CLASHING = ("score", "size", "row", "class", "group", "n", "f1", "task", "rank", "start", "length", "held_out", "place", "y", "shard", "_row", "node", "root", "text_hash", "number")
SPEC = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)

SYLLABLES = {
    "en": "the and ing tion er ed th ly ou nd wh sh".split(),
    "fr": "le eau que ment tre é è ai oi eux ç ou".split(),
    "de": "der und ung sch ein lich ver heit keit ü ä ß".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def made_rows(n: int = 60, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, prose(rng, lang, rng.randint(60, 160)), lang, f"src{i % 4}", 0))
    return rows


def awkward_rows() -> list[tuple]:
    rows = made_rows()
    long = prose(random.Random(9), "en", 30_000)
    return rows + [
        (100, None, "en", "src0", None),
        (101, "", None, None, 0),
        (102, " \t\n ", "fr", "src1", 3),
        (None, "the and ing", None, "src9", 11),
        (None, None, None, None, None),
        (103, rows[0][1], rows[0][2], "src0", 0),
        (103, rows[0][1], rows[0][2], "src0", 0),
        (104, "12 34 +++ 5", None, "src2", 0),
        (105, long, "en", "src3", 0),
        (106, "one", "en", "src5", 3),
        (106, "one", "en", "src5", 3),
        (107, "one two three \x1cfour <|endoftext|>", "en", "src6", 0),
    ]


def frame(spark, rows: list[tuple], extra: bool = True):
    spec = SPEC if extra else "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([r + (("x",) * len(CLASHING) if extra else ()) for r in rows], spec)


@pytest.fixture(scope="session")
def awkward(spark):
    return frame(spark, awkward_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(r[0], int(r[0] % 3 > 0), 0) for r in made_rows()] + [(None, 1, 0), (5, 0, 0), (7, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture
def make(spark):
    """Rows (doc_id, text[, source]) as documents without further columns."""
    return lambda rows: frame(spark, [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows], extra=False)
