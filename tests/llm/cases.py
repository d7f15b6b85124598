"""Small inputs that every operator must take: nulls in any column, empty and very long texts, ties, repeated
rows, clashing extra columns; and brute-force helpers."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("score", "size", "target", "copies", "n_tokens", "n_bytes", "leaks", "label", "cls", "n", "t", "c", "g", "p", "x", "start", "shard", "digest", "block", "quality", "toxic")


def words(rng, n):
    return " ".join(rng.choice(("alder", "birch", "cedar", "delta", "ember", "fjord", "grove", "haven", "isle", "jetty", "knoll", "lagoon", "moor")) + str(rng.randrange(60)) for _ in range(n))


def edge_rows():
    rng = random.Random(3)
    a, long = words(rng, 60), words(rng, 20_000)
    rows = [(1, a, "en", "s1"), (2, a, "en", "s1"), (2, a, "en", "s1"), (3, None, "en", None), (4, "", None, "s2"), (5, " \n\t ", "de", "s2"), (None, words(rng, 40), "en", "s3"),
            (None, words(rng, 40), "en", None), (6, long, "en", "s1"), (7, long + " end", "en", "s1"), (8, "four words are here", "en", "S1"), (9, "Four WORDS are here", "fr", "é"),
            (10, "x" * 5000, "en", "s3"), (11, "日本語 текст émigré   <|endoftext|> a  b", "ja", "s2"), (12, a + " tail one", "en", "s1"), (1, "another text with the same id " + words(rng, 20), "en", "s1"),
            (-5, "a\x00b   c\x85d", "en", "s4"), (13, "MIT License, CC BY cc-by", "en", "s4")]
    rows += [(100 + i, words(rng, 5 + 3 * i), "en", f"s{i % 4}") for i in range(20)]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


def edge_docs(spark, clash=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASH}) if clash else df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table_dir(spark, path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(sets):
    """Component number of each position, by comparing every two sets."""
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(sets))]


def edit_distance_inside(item, text):
    """Least edits between the item and any passage of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
