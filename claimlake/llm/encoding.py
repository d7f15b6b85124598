"""Exact encoding of whole texts with files of public tokenizers.

For a plain byte-level BPE (no normaliser, no prefix space, the usual piece
pattern) a single blank or line break between two characters that are not white space always starts a new
piece, so a text is the concatenation of words led by one of these; letters and the ASCII marks
that end a word are pieces of their own.  Each Arrow batch is split and dictionary-encoded; only the
dictionary's words are looked up, words seen for the first time are encoded, and ids are gathered
by numpy.  Words that touch other white space stay together with their neighbours; a text with a
special string in it, and every text for other tokenizers, goes to the library whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 400_000  # distinct words that a worker remembers
REMEMBERED_CHARS = 64  # longer words are encoded again
CHUNK_BYTES = 4 << 20  # texts taken at once
BLOCK = 1 << 20  # words gathered at once
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@lru_cache(maxsize=8)
def tokenizer_digest(path: str) -> str:
    """Identity of a tokenizer: its file's bytes and the library's version."""
    import sentencepiece
    import tokenizers
    h = hashlib.sha256()
    with open(path, "rb") as f:
        h.update(f.read())
    lib = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    h.update(f"|{'sentencepiece' if path.endswith('.model') else 'tokenizers'} {lib}".encode())
    return h.hexdigest()


def chunks(texts: pa.Array | list) -> Iterator[pa.Array]:
    """Slices of about ``CHUNK_BYTES``; a null text is empty, a longer text is a slice of its own."""
    texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK_BYTES, "right")))
        yield texts.slice(a, b - a)
        a = b


def _strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()  # several times faster than to_pylist


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


class WordEncoder:
    """Remembers the ids of words; subclasses say how strings are encoded (``many``)."""

    def __init__(self, width, splits: bool = True, special: list[str] = ()):
        self.width, self.splits, self.special = np.dtype(width), splits, list(special)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.heads: dict[str, int] = {}
        self.first, self.size, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(4096, self.width)
        self.rows = self.used = 0
        self.room = True

    def many(self, strings: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Parts of the strings: their places, all their ids in that order, and how many belong to each."""
        raise NotImplementedError

    def _add(self, strings: list[str]) -> np.ndarray:
        """Rows of these strings' ids."""
        rows = np.zeros(len(strings), np.int64)
        for which, ids, n in self.many(strings):
            rows[which] = self._put(ids, n)
        return rows

    def _put(self, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        rows, used = self.rows + len(n), self.used + len(ids)
        self.first, self.size, self.flat = _grown(self.first, rows), _grown(self.size, rows), _grown(self.flat, used)
        self.flat[self.used:used] = ids
        self.size[self.rows:rows] = n
        self.first[self.rows:rows] = self.used + np.cumsum(n) - n
        new = np.arange(self.rows, rows)
        self.rows, self.used = rows, used
        return new

    def _gathered(self, rows: np.ndarray) -> np.ndarray:
        """The ids of these rows, one after the other."""
        sizes = self.size[rows]
        ids = np.empty(int(sizes.sum(dtype=np.int64)), self.width)
        at = 0
        for a in range(0, len(rows), BLOCK):
            n = sizes[a:a + BLOCK]
            ends = np.cumsum(n)
            total = int(ends[-1])
            ids[at:at + total] = self.flat[np.repeat(self.first[rows[a:a + BLOCK]] - (ends - n), n) + np.arange(total)]
            at += total
        return ids

    def _rows(self, table: dict[str, int], words: list[str], lead: str = "") -> np.ndarray:
        """Row of each of these distinct words; new ones are encoded, and remembered while there is room."""
        rows = np.fromiter(map(table.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(rows < 0)
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            rows[new] = self._marked(table, fresh, lead) if lead else self._add(fresh)
            if self.room:
                table.update([(w, r) for w, r in zip(fresh, rows[new].tolist()) if len(w) <= REMEMBERED_CHARS])
        return rows

    def _marked(self, table: dict[str, int], words: list[str], lead: str) -> np.ndarray:
        """Rows of new words: letters with marks after them take the ids of both."""
        words = pa.array(words, pa.string())
        stem = pc.utf8_rtrim(words, characters=_MARKS)
        marked = pc.and_(pc.utf8_is_alpha(stem), pc.not_equal(stem, words)).to_numpy(zero_copy_only=False)
        rows = np.zeros(len(words), np.int64)
        rows[~marked] = self._add([lead + w for w in _strings(words.filter(pa.array(~marked)))])
        # a stem may be one of the words just encoded; that costs one more encoding of it, as does a stem led otherwise
        mine, stems = words.filter(pa.array(marked)), stem.filter(pa.array(marked)).dictionary_encode()
        tails = pa.array([w[len(x):] for w, x in zip(_strings(mine), _strings(stems.cast(pa.string())))], pa.string()).dictionary_encode()
        both = np.empty((len(mine), 2), np.int64)
        both[:, 0] = self._rows(table, _strings(stems.dictionary), lead)[stems.indices.to_numpy()]
        both[:, 1] = self._rows(self.heads, _strings(tails.dictionary))[tails.indices.to_numpy()]
        rows[marked] = self._put(self._gathered(both.ravel()), self.size[both].sum(axis=1))
        return rows

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the words of all texts, and where each text's begin (one more at the end)."""
        if not self.splits:
            return self._add(_strings(texts)), np.arange(len(texts) + 1)
        # a line break also starts a word, which keeps it as its first character
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        words, codes, starts = _strings(coded.dictionary), coded.indices.to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        lined = pc.starts_with(coded.dictionary, "\n").to_numpy(zero_copy_only=False)
        inner = pc.replace_substring_regex(coded.dictionary, "^\n", "")
        length = pc.binary_length(inner)
        opens, closes = (pc.and_(pc.equal(pc.binary_length(x), length), pc.greater(length, 0)).to_numpy(zero_copy_only=False)[codes]
                         for x in (pc.utf8_ltrim_whitespace(inner), pc.utf8_rtrim_whitespace(inner)))
        heads = np.zeros(len(codes), bool)
        heads[starts[:-1]] = True
        begins = heads.copy()  # a part begins a word unless white space joins it to the part before it
        begins[1:] |= closes[:-1] & opens[1:]
        for s in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, s).to_numpy(zero_copy_only=False)):
                begins[starts[i] + 1:starts[i + 1]] = False
        at = np.flatnonzero(begins)
        ends = np.append(at[1:], len(codes))
        plain = (ends - at == 1) & ~heads[at]
        rows = np.full(len(at), -1, np.int64)
        taken = codes[at[plain]]
        used = np.bincount(taken, minlength=len(words)) > 0
        place = np.zeros(len(words), np.int64)
        for lead, mask in ((" ", used & ~lined), ("", used & lined)):
            place[mask] = self._rows(self.known, [words[c] for c in np.flatnonzero(mask).tolist()], lead)
        rows[plain] = place[taken]
        odd = np.flatnonzero(~plain)
        runs = []
        for a, b in zip(at[odd].tolist(), ends[odd].tolist()):
            run = " ".join([words[c] for c in codes[a:b].tolist()])
            lead = "" if heads[a] or run[:1] == "\n" else " "
            runs.append((lead + run).replace(" \n", "\n"))
        distinct = list(dict.fromkeys(runs))
        of = dict(zip(distinct, self._rows(self.heads, distinct).tolist()))
        rows[odd] = [of[r] for r in runs]
        return rows, np.searchsorted(at, starts)

    def _begin(self) -> tuple[int, int]:
        """Words of one chunk are all remembered, or, once there is no room, all forgotten after it."""
        self.room = len(self.known) + len(self.heads) < CACHE_WORDS
        return self.rows, self.used

    def _end(self, rows: int, used: int) -> None:
        if not self.room:
            if self.rows - rows > CACHE_WORDS // 4:  # the texts have changed: learn anew
                self._forget()
            else:
                self.rows, self.used = rows, used

    def encode(self, texts: pa.Array | list) -> Iterator[bytes]:
        """Per text its ids as little-endian bytes of ``width``."""
        for chunk in chunks(texts):
            mark = self._begin()
            rows, starts = self._words(chunk)
            sizes, ids = self.size[rows], self._gathered(rows)
            cuts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[starts].tolist()
            self._end(*mark)
            for a, b in zip(cuts, cuts[1:]):
                yield ids[a:b].tobytes()

    def lengths(self, texts: pa.Array | list) -> np.ndarray:
        """Per text its number of ids."""
        out = [np.zeros(0, np.int64)]
        for chunk in chunks(texts):
            mark = self._begin()
            rows, starts = self._words(chunk)
            out.append(np.diff(np.concatenate([[0], np.cumsum(self.size[rows], dtype=np.int64)])[starts]))
            self._end(*mark)
        return np.concatenate(out)


class Encoder(WordEncoder):
    """ids as the tokenizer's library gives them; the tokenizer's file is opened in the task."""

    JOINED = 256  # words in one call

    def __init__(self, path: str):
        self.line = None
        if path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda texts: sp.encode(texts, num_threads=1)
            super().__init__("<u2" if sp.get_piece_size() <= 65536 else "<u4", splits=False)
            return
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tk = Tokenizer.from_file(path)
        tk.no_truncation()
        tk.no_padding()
        self.library = lambda texts: [e.ids for e in tk.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = [a["content"] for a in spec.get("added_tokens") or []]
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        splits = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and model.get("type") == "BPE"
                  and pre.get("use_regex") is True and not pre.get("add_prefix_space") and not model.get("dropout")
                  and not any(" " in s for s in special))
        super().__init__("<u2" if tk.get_vocab_size() <= 65536 else "<u4", splits, special)
        line = self.library(["\n"])[0]
        self.line = line[0] if splits and len(line) == 1 else None

    def many(self, strings: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """A line break before a word is a piece of its own, so words without white space at their ends are encoded many to a text."""
        blank_led, lined, alone = [], [], []
        for i, s in enumerate(strings):
            whole = self.line is not None and len(s) > 1 and "\n" not in s[1:] and not s[1].isspace() and not s[-1].isspace()
            (alone if not whole else lined if s[0] == "\n" else blank_led).append(i)
        for joined, between in ((blank_led, "\n"), (lined, "")):
            for a in range(0, len(joined), 64 * self.JOINED):
                groups = [joined[b:b + self.JOINED] for b in range(a, min(a + 64 * self.JOINED, len(joined)), self.JOINED)]
                texts = [between.join([strings[i] for i in g]) for g in groups]
                for group, text, ids in zip(groups, texts, self.library(texts)):
                    ids = np.array(ids, self.width)
                    cuts = np.flatnonzero(ids == self.line)
                    if len(cuts) != len(group) - len(between) or any(x in text for x in self.special):
                        alone += group
                    elif between:
                        yield group, ids[ids != self.line], np.diff(cuts, prepend=-1, append=len(ids)) - 1
                    else:
                        yield group, ids, np.diff(cuts, append=len(ids))
        for a in range(0, len(alone), 256):
            group = alone[a:a + 256]
            found = self.library([strings[i] for i in group])
            yield group, np.array([x for ids in found for x in ids], self.width), np.array([len(ids) for ids in found], np.int64)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)
