import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies string, digest long, bin int"


def awkward_rows():
    """Nulls, empty and long texts, ties, repeated rows, copies, near copies."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, base = [], [rnd.choice(words) for _ in range(300)]
    for i in range(60):
        rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 200))), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "é", None])))
    for i in range(60, 90):
        near = list(base)
        near[rnd.randrange(300)] = f"changed{i % 7}"
        rows.append((i, " ".join(near), "en", "a"))
    rows += [(i, "The Same\tText again " * 3, "en", "a") for i in range(90, 110)]
    rows += [(110, "THE SAME\ttext AGAIN " * 3, "en", "b"), (111, None, None, None), (112, "", "en", "a"), (113, " \t\n", "en", "a"), (None, "no id", "en", "a"), (None, "no id", "en", "a"), (114, "Ünïcode ÄÖ", "de", "b"), (115, "ünïcode äö", "de", "b")]
    rows += [(116, "twice over", "en", "a")] * 3 + [(117, "long " * 30000 + "tail", "en", "z"), (118, "line one here\nline one here\n\nline two\nline one here", "en", "a"), (119, "a#b $$ % & | < > *" * 9, "en", "b")]
    return [(d, t, lang, s, len(t or ""), "x", 1, 2) for d, t, lang, s in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
