"""Byte-level BPE: encoding by a segment tree over pair ranks, and decoding."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import table, whole_text

#: Fixed value: how byte-level vocabularies split a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose ids a worker remembers before it starts anew.
REMEMBER = 600_000
_NONE = 1 << 62
_LETTERS, _NUMBERS, _WHITE = r"A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾", r"\x09-\x0d\x20\x85\xa0"
#: The same pattern up to U+02AF, with its classes written out, for the faster engine.
_NARROW = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_WHITE}{_LETTERS}{_NUMBERS}]+"
    f"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
).findall
_WIDE = re.compile("[^\0-ʯ]").search


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


_PIECES = regex.compile(PATTERN).findall


def pieces_of(text: str) -> list[str]:
    """A text split by the pattern."""
    return _PIECES(text) if _WIDE(text) else _NARROW(text)


class Vocabulary:
    """Ids, merge ranks and special strings of a byte-level BPE file in JSON."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        ids = data["model"]["vocab"]
        letters = byte_letters()
        self.start = [ids[letters[b]] for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        values = {letter: byte for byte, letter in letters.items()}
        self.bytes = {i: bytes(values[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes |= {i: content.encode() for content, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.tokens = pa.array([self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)], pa.large_binary())
        self.missing = np.setdiff1d(np.arange(len(self.tokens)), list(self.bytes))
        pairs = np.array([a << 32 | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.ranks = np.array([rank for rank, _ in self.merges.values()], dtype=np.int64)[order]
        self.made = np.zeros(int(self.ranks.max()) + 1, dtype=np.int64)  # id by rank
        for rank, made in self.merges.values():
            self.made[rank] = made

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one piece.

        A segment tree holds rank and place of every adjacent pair; its root is the
        lowest rank, the leftmost of equals. A merge changes three leaves, each in
        logarithmic time, so a piece of any length takes n log n.
        """
        ids = [self.start[b] for b in word]
        n = len(ids)
        if n == 1:
            return (ids[0],)
        merges = self.merges
        size = 1 << (n - 1).bit_length()
        tree = [_NONE] * (2 * size)
        made = [0] * n  # the id that the pair beginning here becomes
        any_pair = False
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                tree[size + i] = found[0] << 32 | i
                made[i] = found[1]
                any_pair = True
        if not any_pair:
            return tuple(ids)
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n
        while tree[1] != _NONE:
            i = tree[1] & 0xFFFFFFFF
            j = after[i]
            ids[i] = made[i]
            alive[j] = False
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            found = merges.get((ids[i], ids[k])) if k < n else None
            if found:
                made[i] = found[1]
            changed = [(j, _NONE), (i, found[0] << 32 | i if found else _NONE)]
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], ids[i]))
                if found:
                    made[h] = found[1]
                changed.append((h, found[0] << 32 | h if found else _NONE))
            for at, value in changed:
                at += size
                if tree[at] == value:
                    continue
                tree[at] = value
                at >>= 1
                while at:
                    a, b = tree[2 * at], tree[2 * at + 1]
                    low = a if a < b else b
                    if tree[at] == low:
                        break
                    tree[at] = low
                    at >>= 1
        return tuple(x for x, keep in zip(ids, alive) if keep)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of many pairs at once; _NONE where a pair does not merge."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.ranks[at], _NONE)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """`merge` of many short pieces: a segment tree per row, all rows a step at a time; ids as 32-bit numbers."""
        out = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            by_size.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(k)
        for size, rows in by_size.items():
            for at in range(0, len(rows), 8192):
                part = rows[at : at + 8192]
                for k, ids in zip(part, self._merge_rows([words[k] for k in part], size)):
                    out[k] = ids
        return out

    def _merge_rows(self, words: list[bytes], size: int) -> list[bytes]:
        """Arrays are flat, a row behind the other; places in them are taken once for each step."""
        n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), dtype=np.uint8).reshape(-1, size)
        ids = np.array(self.start, dtype=np.int64)[raw]
        places = np.arange(size)
        alive = places < n[:, None]
        after, before = np.tile(places + 1, (len(words), 1)).ravel(), np.tile(places - 1, (len(words), 1)).ravel()
        tree = np.full((len(words), 2 * size), _NONE, dtype=np.int64)
        at, place = np.nonzero(places[:-1] < n[:, None] - 1)
        rank = self._rank(ids[at, place], ids[at, place + 1])
        tree[at, size + place] = np.where(rank < _NONE, rank << 8 | place, _NONE)
        level = size
        while level > 1:
            half = level >> 1
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        row = np.flatnonzero(tree[:, 1] < _NONE)
        shape, ids, alive, tree = ids.shape, ids.ravel(), alive.ravel(), tree.ravel()
        while len(row):
            row_at, tree_at = row * size, row * (2 * size)
            root = tree[tree_at + 1]
            i = root & 0xFF
            at = row_at + i
            j = after[at]
            new = self.made[root >> 8]
            ids[at] = new
            alive[row_at + j] = False
            k = after[row_at + j]
            after[at] = k
            h = before[at]
            with_next, with_last = np.flatnonzero(k < n[row]), np.flatnonzero(h >= 0)
            next_at, last_at = row_at[with_next] + k[with_next], row_at[with_last] + h[with_last]
            before[next_at] = i[with_next]
            # the pairs on both sides are looked up together
            rank = self._rank(
                np.concatenate([new[with_next], ids[last_at]]), np.concatenate([ids[next_at], new[with_last]])
            )
            value = np.where(rank < _NONE, rank << 8 | np.concatenate([i[with_next], h[with_last]]), _NONE)
            leaves = tree_at + size
            tree[leaves + i] = _NONE
            tree[leaves + j] = _NONE
            tree[leaves[with_next] + i[with_next]] = value[: len(with_next)]
            tree[leaves[with_last] + h[with_last]] = value[len(with_next) :]
            # j is behind i, h before it; paths are walked from both ends and from the middle
            for leaf in (i, j, np.maximum(h, 0)):
                node = size + leaf
                for _ in range(size.bit_length() - 1):
                    node = node >> 1
                    pair = tree_at + 2 * node
                    tree[tree_at + node] = np.minimum(tree[pair], tree[pair + 1])
            row = row[tree[tree_at + 1] < _NONE]
        flat = ids[alive].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(alive.reshape(shape).sum(axis=1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, wanted: set[str]) -> None:
        """Makes pieces known: those that are new are merged together."""
        new = wanted.difference(self.known)
        if len(self.known) + len(new) > REMEMBER:
            self.known.clear()
            new = wanted
        pieces = list(new)
        raw = [p.encode("utf-8", "replace") for p in pieces]
        short = [k for k, word in enumerate(raw) if len(word) <= 64]
        self.known.update(zip([pieces[k] for k in short], self.merge_many([raw[k] for k in short])))
        self.known.update(
            (pieces[k], np.array(self.merge(word), dtype=np.int32).tobytes()) for k, word in enumerate(raw) if len(word) > 64
        )

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one behind the other, and where each text begins and the last ends.

        The special strings in a text become their own ids.
        """
        plain, marks = [], []
        for text in texts:
            special = any(map(text.__contains__, self.special))
            marks.append([self.special[m] for m in self.cut.findall(text)] if special else [])
            plain.append([pieces_of(t) for t in (self.cut.split(text) if special else [text])])
        wanted = set().union(*(part for parts in plain for part in parts))
        self.learn(wanted)
        get, out = self.known.__getitem__, []
        for parts, own in zip(plain, marks):
            ids = b"".join(map(get, parts[0]))
            for mark, part in zip(own, parts[1:]):
                ids += mark.to_bytes(4, sys.byteorder) + b"".join(map(get, part))
            out.append(ids)
        for piece in wanted:
            if len(piece) > 64:  # long ones do not recur and would fill the memory
                del self.known[piece]
        return np.frombuffer(b"".join(out), dtype=np.int32), np.cumsum([0, *map(len, out)]) // 4

    def encode(self, text: str) -> list[int]:
        """Ids of one whole text."""
        return self.encode_all([text])[0].tolist()

    def decode(self, ids) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """`decode` of many texts, whose ids follow one another as in `encode_all`."""
        if len(self.missing) and np.isin(flat, self.missing).any():
            raise KeyError("an id that the vocabulary does not hold")
        taken = self.tokens.take(pa.array(flat))
        size = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(flat) + 1]
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(size[ends]), taken.buffers()[2]])
        try:
            return pc.cast(pc.cast(raw, pa.binary()), pa.string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8 in some text
            return pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _mapped(docs: DataFrame, columns: list[Column], schema: str, path: str, of) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # ids take more room than text
                yield of(known, batch.slice(at, 256))

    return docs.select(*columns).mapInArrow(run, schema)


def _ids(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>), one per input row; a null or empty text has no ids.

    Whole texts are encoded, of any length; no special ids are added. A special string of
    the vocabulary that stands in a text becomes its id. Null ids and repeated rows pass.
    `path` is the vocabulary file, at the same place on every machine.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def of(known: Vocabulary, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = _ids(*known.encode_all(batch.column(1).to_pylist()))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    return _mapped(docs, [F.col(id_col), whole_text(text_col).alias("text")], f"{id_col} {kind}, ids array<int>", path, of)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text) from rows with an array of ids; null or empty arrays give an empty text."""
    kind = tokens.schema[id_col].dataType.simpleString()

    def of(known: Vocabulary, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [known.decode(ids or ()) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return _mapped(tokens, [F.col(id_col), F.col(ids_col).alias("ids")], f"{id_col} {kind}, text string", path, of)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids, text): `encode` and then `decode` of its ids, in one pass over the rows."""
    kind = docs.schema[id_col].dataType.simpleString()

    def of(known: Vocabulary, batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, ends = known.encode_all(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), _ids(flat, ends), known.decode_all(flat, ends)], [id_col, "ids", "text"])

    schema = f"{id_col} {kind}, ids array<int>, text string"
    return _mapped(docs, [F.col(id_col), whole_text(text_col).alias("text")], schema, path, of)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = round_trip(table(spark, sf_dir, "documents"), default_path())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op1_bpe": op1_bpe}
