"""A table of documents with nulls, empties, ties, repeats, long texts and clashing names."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, lo string, size string, "
    "base string, path string, part string, file string, chunk string, start string, bucket string, digest string, "
    "_row string, __row_id string, row string, tokens string"
)
_OTHERS = (True, *["x"] * 14)

PASSAGE = " ".join(f"passage{i}" for i in range(20))


def texts() -> list[str | None]:
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "ß.", "x\x1cy", "😀,", "don't", "12.5", "A", "of", "the", "日本語"]
    some = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(14)]
    return [
        *some,
        some[0],
        some[1],
        some[1],
        some[2] + " end",
        "Two " + PASSAGE,
        PASSAGE + " one",
        "é" + PASSAGE + PASSAGE,
        "same line here\n" * 30 + "\n \t\n",
        "a" * 5000,
        "ab" * 700 + "▁",
        "▁under",
        "a <|EndOfText|> b <|endoftext|> <|startoftext|>",
        "  two  spaces and lines\r\n",
        "".join(chr(c) for c in range(1, 0x250)),
        " ".join(rng.choices(words, k=30_000)),
        "",
        None,
        " ",
        "\0",
        "x",
    ]


def documents() -> list[tuple]:
    rng = random.Random(6)
    rows = []
    for i, text in enumerate(texts()):
        source = rng.choice(["hot", "hot", "hot", "é", "Z", "", None])
        rows.append((3 * i + rng.randint(0, 2), text, rng.choice(["en", "de", None]), source, rng.choice([None, i]), *_OTHERS))
    rows += [rows[3], rows[3], rows[17]]  # whole rows again
    rows += [(1000 + i, f"short {i}", None, "only " + str(i), i, *_OTHERS) for i in range(40)]
    rows += [(2000 + i, "Many of one source " + "Z" * (i % 7), "en", "hot", None, *_OTHERS) for i in range(300)]
    rng.shuffle(rows)
    return rows


def write(spark, folder: str, rows: list[tuple], files: int = 3) -> str:
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(f"{folder}/documents.parquet")
    return folder
