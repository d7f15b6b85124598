"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each Spark partition.

The rank table gives a merge table: (left id, right id) -> id of the joined bytes.  A word starts as its
bytes' ids; each round of the recursive query lays its tokens out as (word, position) rows, joins neighbours with
the merge table and contracts the word's leftmost pair of least rank; a word without
such a pair is done.  A word that is itself in the table is one token from the start.  Decoding lays out a text's
ids as (text, position) rows and puts their bytes together by an ordered aggregation.

Words are what the piece pattern matches; each distinct one is encoded once per worker (see ``encoding``).
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.encoding import WordEncoder, chunks

WORDS, WORD_BYTES = 20_000, 1 << 18  # words, and their bytes, in one query; a longer word is a query of its own
TOKENS = 1 << 18  # ids decoded in one query; a text's ids may need several
KNOWN_PIECES = 200_000
MEMORY = "300MB"

_MERGES = """
CREATE TABLE merges AS
SELECT l.id AS a, r.id AS b, v.id AS rank
FROM (SELECT id, hex, 2 * unnest(range(1, len(hex) // 2)) AS cut FROM vocab) v
JOIN vocab l ON l.hex = v.hex[:v.cut] JOIN vocab r ON r.hex = v.hex[v.cut + 1:]
"""
# A state is a word with its tokens; keyed by the word, so that a round replaces it. rank and position in one number: least rank, then leftmost.
_CONTRACT = """
WITH RECURSIVE s(word, tokens, open) USING KEY (word) AS (
  SELECT word, tokens, true FROM started
  UNION ALL
  SELECT s.word,
         CASE WHEN m.pair IS NULL THEN s.tokens ELSE s.tokens[:m.pair % 4294967296 - 1] || [(m.pair // 4294967296)::INT] || s.tokens[m.pair % 4294967296 + 2:] END,
         m.pair IS NOT NULL
  FROM s LEFT JOIN (
    SELECT p.word, min(merges.rank::BIGINT * 4294967296 + p.position) AS pair
    FROM (SELECT word, unnest(tokens[:-2]) AS a, unnest(tokens[2:]) AS b, unnest(range(1, len(tokens))) AS position FROM s WHERE open) p
    JOIN merges ON merges.a = p.a AND merges.b = p.b
    GROUP BY p.word) m ON m.word = s.word
  WHERE s.open
)
SELECT tokens FROM s ORDER BY word
"""
_DECODE = "SELECT unhex(string_agg(hex, '' ORDER BY position)) AS bytes FROM ids JOIN vocab USING (id) GROUP BY text ORDER BY text"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and a number on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Bpe(WordEncoder):
    """Encodes and decodes; one in-memory DuckDB per worker, one thread, bounded memory, no files."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        super().__init__("<u4")
        self.ranks, self.pattern, self.pieces = read_ranks(path), regex.compile(pattern), {}
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        vocab = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [b.hex() for b in self.ranks]})  # noqa: F841  read by the next line
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM vocab")
        self.db.execute(_MERGES)

    def _contracted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and how many belong to each."""
        sizes = np.array([len(w) for w in words])
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        tokens = pa.ListArray.from_arrays(offsets, pa.array(self.single[np.frombuffer(b"".join(words), np.uint8)]))
        self.db.register("started", pa.table({"word": np.arange(len(words), dtype=np.int32), "tokens": tokens}))
        done = self.db.sql(_CONTRACT).to_arrow_table().column("tokens").combine_chunks()
        return done.flatten().to_numpy(zero_copy_only=False), np.diff(done.offsets.to_numpy())

    def _learn(self, pieces: list[bytes]) -> dict[bytes, np.ndarray]:
        found = {p: np.array([self.ranks[p]], np.uint32) for p in pieces if p in self.ranks}
        rest = [p for p in pieces if p not in found]
        while rest:
            ends = np.cumsum([len(p) for p in rest[:WORDS]])
            n = max(1, int(np.searchsorted(ends, WORD_BYTES, "right")))
            ids, sizes = self._contracted(rest[:n])
            found.update(zip(rest[:n], np.split(ids.astype(np.uint32), np.cumsum(sizes)[:-1])))
            rest = rest[n:]
        return found

    def many(self, strings: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        split = [[p.encode() for p in self.pattern.findall(s)] for s in strings]
        known = self.pieces
        new = self._learn(list(dict.fromkeys(p for s in split for p in s if p not in known)))
        ids = [known[p] if p in known else new[p] for s in split for p in s]
        if len(known) < KNOWN_PIECES:
            known.update((p, i) for p, i in new.items() if len(p) <= 32)
        ends = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        yield list(range(len(strings))), flat, np.diff(ends[np.cumsum([0] + [len(s) for s in split])])

    def decode(self, texts: list[np.ndarray]) -> Iterator[bytes]:
        """The bytes of each list of ids."""
        batch, n = [], 0
        for i, ids in enumerate(texts):
            batch.append(ids)
            n += len(ids)
            if n >= TOKENS or i == len(texts) - 1:
                yield from self._decoded(batch)
                batch, n = [], 0

    def _decoded(self, texts: list[np.ndarray]) -> list[bytes]:
        parts = [(t, ids[a:a + TOKENS]) for t, ids in enumerate(texts) for a in range(0, len(ids), TOKENS)]  # a long text in pieces
        out: list[list[bytes]] = [[] for _ in texts]
        while parts:
            n, taken = 0, 0
            while taken < len(parts) and (not taken or n + len(parts[taken][1]) <= TOKENS):
                n += len(parts[taken][1])
                taken += 1
            here, parts = parts[:taken], parts[taken:]
            sizes = [len(ids) for _, ids in here]
            self.db.register("ids", pa.table({"text": np.repeat(np.arange(len(here), dtype=np.int32), sizes), "position": np.arange(n, dtype=np.int32),
                                              "id": np.concatenate([ids for _, ids in here]).astype(np.int32)}))
            for (t, _), piece in zip(here, self.db.sql(_DECODE).to_arrow_table().column("bytes").to_pylist()):
                out[t].append(piece)
        return [b"".join(o) for o in out]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for b in batches:
            at = 0
            for chunk in chunks(b.column("__text")):
                ids = pa.array([pa.array(np.frombuffer(x, "<u4").astype(np.int64)) for x in bpe.encode(chunk)], pa.list_(pa.int64()))
                kept = [b.column(i).slice(at, len(chunk)) for i, n in enumerate(b.schema.names) if n != "__text"]
                yield pa.RecordBatch.from_arrays([*kept, ids], [*[n for n in b.schema.names if n != "__text"], "ids"])
                at += len(chunk)
    return run


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with ``ids`` (array of bigint) in place of a column of that name.

    Ids are those of the rank file's tokenizer over the matches of ``pattern``, without special tokens.  A null or empty text has no
    ids; repeated rows stay; an empty table gives an empty result.  Memory: one Arrow batch, ``CACHE_WORDS`` words, and for a very long
    text its ids.  A match without a break, such as a run of letters, takes time with the square of its length.
    """
    keep = [c for c in docs.columns if c not in (text, "ids")]
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"] + ["ids array<bigint>"])
    return rows.mapInArrow(_encode(path, pattern), schema)


def _digests(path: str, pattern: str, key: str):
    """Per row the digests of its ids and of what they decode to, without an array of ids between the two."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for chunk in chunks(b.column("__text")):
                ids = list(bpe.encode(chunk))
                n += [len(x) // 4 for x in ids]
                of_ids += [hashlib.sha256(x).hexdigest() for x in ids]
                of_bytes += [hashlib.sha256(x).hexdigest() for x in bpe.decode([np.frombuffer(x, "<u4") for x in ids])]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                                             [key, "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes and decodes every text: key, n_tokens, ids_sha256 (little-endian u32), decoded_sha256; cases as in ``encoded``."""
    rows = docs.select(F.col(key).cast("bigint").alias(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    return rows.mapInArrow(_digests(path, pattern, key), f"{key} bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for b in batches:
            ids = [np.array(x or [], np.uint32) for x in b.column("ids").to_pylist()]
            kept = [n for n in b.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in kept], pa.array(list(bpe.decode(ids)), pa.binary())], [*kept, "bytes"])
    return run


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of ``rows`` but ``ids``, with ``bytes``: what the ids stand for.  Null or no ids give no bytes."""
    kept = rows.select(*[c for c in rows.columns if c not in ("ids", "bytes")], "ids")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "ids"] + ["bytes binary"])
    return kept.mapInArrow(_decode(path, pattern), schema)
