import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "id long, name string, c string, _id string, _text string, _kept string, key string, c0 long"
)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS)[:2] for _ in range(n))


def texts():
    """Texts with nulls, empty ones, blanks, a very long one, exact and near copies, and shared lines."""
    rng = random.Random(7)
    plain = [sentence(rng, rng.randint(1, 60)) for _ in range(40)]
    long = sentence(rng, 4000)
    line = "This line stands in many of the documents, word for word."
    out = [None, "", " ", "\n", "word", "word", "  Word\t", "a\x0bb\x0cc", "é ñ ü\n日本語 テキスト", *plain, long]
    out += [plain[0], plain[0], plain[0].replace(" ", "  "), plain[1].upper(), plain[2] + " tail"]
    for p in plain[3:8]:
        words = p.split()
        words[len(words) // 2] = "changed"
        out += [" ".join(words), p + " more"]
    out += [f"{p}\n{line}\n{p[:30]}\n\n  {line.upper()} " for p in plain[10:16]]
    out += [long.replace("alpha", "omega", 3), "x" * 900, "xy" * 500, "token = abcdefgh12 AKIA" + "Z" * 14]
    return out


def rows_of(some):
    sources = [None, "b", "a", "ä", "B"]
    rows = []
    for i, t in enumerate(some):
        key = None if i == 12 else 3 * i
        rows.append((key, t, None, sources[i % 5], 1, 9, "n", "c", "i", "t", "k", "q", 5))
    return rows


@pytest.fixture(scope="session")
def raw():
    """Rows as tuples; the last two repeat an id, one with the same text and one with another."""
    rows = rows_of(texts())
    again = list(rows[20])
    other = [*again]
    other[1] = "another text under the same id"
    return [*rows, tuple(again), tuple(other)]


@pytest.fixture(scope="session")
def docs(spark, raw):
    return spark.createDataFrame(raw, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
