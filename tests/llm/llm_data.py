import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, doc string, row string, hits string, "
    "hash long, pos long, line string, key string, own string, range long, next string, part long, start string, score string, "
    "fingerprint string, component_id string, dropped string, window long, `_id` string, `_gone` string, `_text` string"
)
EXTRA = SCHEMA.count(",") + 1 - 5


def as_docs(spark, rows):
    """Rows of (doc_id, text, lang) with every further column null or set to something odd."""
    full = [(i, t, lang, "s", None if t is None else len(t), *[None] * EXTRA) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


def messy_rows():
    draw = random.Random(5)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa Lambda MU nu xi".split()
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))
    shared = "This line of more than forty characters is shared by many documents."
    base = prose(120)
    rows = [
        (None, "a text without an id", "en"), (1, None, "en"), (2, "", "en"), (3, " \t\n \r\n", None), (4, "12 345 --- ...", "de"),
        (5, prose(30_000), "en"), (6, base, "en"), (7, base, "en"), (7, base, "en"), (8, base + " more", "en"),
        (9, "x", "fr"), (10, "😀 ünï çödé Ωmega " * 30, "de"), (11, "no-spaces-" * 3000, "es"), (12, "\n".join([shared] * 4), "en"),
        (2**62, prose(10), "en"), (-5, prose(11), "fr"),
    ]
    rows += [(20 + i, f"{prose(5)}\n  {shared.upper() if i % 2 else shared}\t\n{prose(3)}\n", "en") for i in range(8)]
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return as_docs(spark, messy_rows()).cache()


@pytest.fixture(scope="session")
def none(spark):
    return as_docs(spark, [])
