import random

import pytest

CLASH = "score int, size int, key int, source_size int, target int, fp int, root int, h int, y int, cut int, rest int, epochs int, tie int, raw int, part int, component_id int, verdict int, rule int"
DOC = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "house", "green", "walks", "seven", "stone", "bread", "of", "under", "light", "grows", "slowly", "and", "over", "winter"]) + rng.choice(["", "", "s", "er", ".", ","]) for _ in range(n))


def row(i, text, source="a", lang="en"):
    return (i, text, lang, source, None if text is None else len(text), *[7] * 18)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with nulls in every column, empty, very long and repeated texts, ties, and extra columns that clash."""
    rng = random.Random(5)
    rows = [row(i, prose(rng, rng.randrange(5, 120)), rng.choice("abc")) for i in range(1, 121)]
    base = prose(rng, 200)
    rows += [row(200 + i, base, "hot") for i in range(30)]  # exact copies
    rows += [row(300 + i, base + " extra" * (i % 2) + f" tail{i}", "hot") for i in range(10)]  # near copies
    rows += [row(400, None), row(401, ""), row(402, " \n\t "), row(403, "one"), row(404, "x" * 20_000), row(405, prose(rng, 20_000), "long")]
    rows += [row(406, "null source here", None), row(None, "null id here"), (407, None, None, None, None, *[None] * 18), (408, "mixed \u00e9\u00fc \u4e2d\u6587 \U0001f600 <|endoftext|> text", None, "b", None, *[None] * 18)]
    rows += [row(1, rows[0][1], rows[0][3])] * 2  # repeated rows
    return spark.createDataFrame(rows, DOC).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def fold(i, k):
    import zlib

    return zlib.crc32(str(i).encode()) % k


@pytest.fixture(scope="session")
def labelled(spark):
    """(documents, labels): toxic ones hold insults, poor ones shout or repeat."""
    rng = random.Random(9)
    bad = ["blorg", "snarf", "grumble", "fnord"]
    rows, labels = [], []
    for i in range(600):
        words, toxic, poor = prose(rng, rng.randrange(20, 150)).split(), int(rng.random() < 0.2), int(rng.random() < 0.2)
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        text = " ".join(words)
        if poor:
            text = rng.choice([text.upper().replace(" ", "!! "), " ".join(w for w in words for _ in range(6)), " ".join(w + "%%%" for w in words)])
        rows.append((i, text, "en", "a", len(text)))
        labels.append((i, 1 - poor, toxic))
    labels += [(None, 1, 1), (5, None, None), (99_999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()
