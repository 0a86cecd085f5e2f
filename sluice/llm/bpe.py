"""Operator 7, BPE encoding and decoding by per-prefix dynamic programming.

Texts are cut at the vocabulary's added tokens and then by its split pattern into pieces; a piece's ids
do not depend on its neighbours.  For every prefix of a piece exactly one token can be the last one of
the prefix's encoding.  It is found among the tokens that end there, which a suffix automaton
(Aho-Corasick over the vocabulary) yields: a token t that leaves prefix p is the last one if t alone
encodes itself and the last token of p and t are compatible, that is, if encoding the two side by side
gives the two.  Back-pointers then give the ids.  A piece of n bytes takes O(n) tests, whatever it repeats.

Two tokens are compatible if no merge across their border would have come before the merges that built
them.  Only tokens on the right edge of the left one's merge tree and on the left edge of the right one's
can meet at the border, so the test walks down those two edges from the last merge back.

Decoding joins the tokens' bytes and reads them as UTF-8, invalid bytes replaced.

Defined results.  Null text: empty, no ids.  Null doc_id: kept as null.  Repeated rows: one result each.
Empty table: no rows.  Other columns are not read, or are carried along by ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import re as _re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, take_worker, worker_cache

#: Pieces whose ids a worker remembers twice over: a full table becomes the old one, which is asked before a piece is
#: encoded anew, so frequent pieces stay known; nothing else changes.
REMEMBERED = 250_000
#: Pairs of tokens whose compatibility a worker remembers, in the same way.
PAIRS = 400_000
#: Bytes of the longest piece worth remembering.
LONGEST = 64
NO_RANK = 1 << 62


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it is printable,
    else the next free letter from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def plain(pattern: str):
    """The same pattern for ``re``, which is faster than ``regex``, with letters, numbers and white space spelled out
    as sets; it holds for texts without characters beyond U+FFFF.  None if the pattern has other escapes."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    held = {k: "".join(f"{_re.escape(m[0])}-{_re.escape(m[-1])}" for m in regex.findall(f"{k}+", every)) for k in (r"\p{L}", r"\p{N}", r"\s")}

    def spelled(m) -> str:
        if m[0] == r"\S":
            return f"[^{held[r'\s']}]"
        inside = "".join(held[k] for k in _re.findall(r"\\p\{[LN]\}|\\s", m[0]))
        return f"[{'^' * m[0].startswith('[^')}{inside}]"

    atom = r"\[\^?(?:\\p\{[LN]\}|\\s)+\]|\\p\{[LN]\}|\\s|\\S"
    return None if "\\" in _re.sub(atom, "", pattern) else _re.compile(_re.sub(atom, spelled, pattern))


#: A character that ``plain`` does not know.
BEYOND = _re.compile("[\U00010000-\U0010ffff]")


class Vocabulary:
    """A byte-level BPE vocabulary file, with what encoding and decoding need."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("only byte-level BPE files without a normalizer are read")
        to_byte = {c: b for b, c in byte_letters().items()}
        self.pattern, self.plain = regex.compile(pattern), plain(pattern)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with matching rules are not read")
        self.added = added
        self.split_added = _re.compile("(" + "|".join(_re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        size = max([*model["vocab"].values(), *added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        ids: dict[bytes, int] = {}
        for s, i in model["vocab"].items():
            if s not in added:
                self.bytes[i] = bytes(to_byte[c] for c in s)
                ids[self.bytes[i]] = i
        for s, i in added.items():
            self.bytes[i] = s.encode()
        self.ids = ids
        #: rank of the merge that builds a token, and its two halves; single bytes have neither
        self.rank = [-1] * size
        self.left, self.right = [-1] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (bytes(to_byte[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            i, j, k = ids[a], ids[b], ids[a + b]
            self.merge.setdefault((i, j), rank)
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = rank, i, j
        self.single = [ids[bytes([b])] for b in range(256)]
        self.automaton = ahocorasick.Automaton()
        for raw, i in ids.items():
            if len(raw) > 1 and self.rank[i] >= 0:
                self.automaton.add_word(raw.decode("latin-1"), (len(raw), i))
        self.automaton.make_automaton()
        self.known: dict[int, bool] = {}
        self.memory = Memory(self)

    def compatible(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of a and b side by side gives a, b."""
        key = a << 24 | b
        got = self.known.get(key)
        if got is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            got = self.known[key] = self._border(a, b)
        return got

    def _border(self, a: int, b: int) -> bool:
        # going back in time: the edge token of either side that is merged away last is taken apart first
        rank, merge = self.rank, self.merge
        until_a = until_b = NO_RANK  # ranks of the merges that swallow a and b
        while True:
            cross = merge.get((a, b))
            # at equal rank the leftmost pair is merged first: one inside a before the border, one inside b after
            if cross is not None and cross < until_a and cross <= until_b:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra >= rb:
                until_a, a = ra, self.right[a]
            else:
                until_b, b = rb, self.left[b]

    def piece(self, raw: bytes) -> list[int]:
        """The ids of one piece."""
        n = len(raw)
        if n == 1:
            return [self.single[raw[0]]]
        single, known = self.single, self.known.get
        last = [-1, *[single[b] for b in raw]]  # where no longer token is compatible, the last byte alone
        start = list(range(-1, n))
        done = -1
        for end, (size, t) in self.automaton.iter(raw.decode("latin-1")):  # those of one end come longest first
            if end == done:
                continue
            p = end + 1 - size
            if p:
                fits = known(last[p] << 24 | t)
                if fits is None:
                    fits = self.compatible(last[p], t)
                if not fits:
                    continue
            last[end + 1], start[end + 1], done = t, p, end
        out = []
        at = n
        while at:
            out.append(last[at])
            at = start[at]
        return out[::-1]

    def said(self, text: str) -> list[tuple[str, int, bytes]]:
        """Of every piece of a text: the decimal ids joined by commas, their number, their bytes."""
        parts = self.split_added.split(text) if self.split_added else [text]
        pieces = (self.pattern if self.plain is None or BEYOND.search(text) else self.plain).findall
        if len(parts) == 1:
            return list(map(self.memory.__getitem__, pieces(text)))
        out: list[tuple[str, int, bytes]] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append((str(self.added[part]), 1, self.bytes[self.added[part]]))
            else:
                out += map(self.memory.__getitem__, pieces(part))
        return out

    def encode_text(self, text: str) -> str:
        """The decimal ids of a text, joined by commas."""
        return ",".join([p[0] for p in self.said(text)])

    def encode(self, text: str) -> np.ndarray:
        return numbers(self.encode_text(text))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def numbers(said: str) -> np.ndarray:
    return np.fromstring(said, dtype=np.int32, sep=",") if said else np.zeros(0, np.int32)


class Memory(dict):
    """piece -> (its ids joined by commas, how many, the bytes that they decode to), made when first asked for.

    Decoding joins the bytes of all ids and reads them as UTF-8 in the end, so it may as well join pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.names = [str(i) for i in range(len(vocabulary.bytes))]
        self.old: dict[str, tuple[str, int, bytes]] = {}

    def __missing__(self, piece: str) -> tuple[str, int, bytes]:
        got = self.old.get(piece)
        if got is None:
            ids = self.vocabulary.piece(piece.encode("utf-8"))
            got = (",".join(map(self.names.__getitem__, ids)), len(ids), b"".join(map(self.vocabulary.bytes.__getitem__, ids)))
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = got
        return got


_loaded: dict[tuple[str, str], Vocabulary] = {}
worker_cache(_loaded.clear)


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """The vocabulary of a file, loaded once in a worker."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Vocabulary(path, pattern)
    return _loaded[path, pattern]


def _encode(path: str, pattern: str, with_ids: bool, with_row: bool, slice_bytes: int = 1 << 22):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_worker("bpe")
        v = vocabulary(path, pattern)
        for whole in batches:
            step = max(1, whole.num_rows * slice_bytes // max(1, whole.nbytes))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                n, sha, back, ids = [], [], [], []
                for text in b.column("text"):
                    # the bytes of the ids of all pieces, one after another, are what decoding them all gives
                    pieces = v.said(text.as_py() or "")
                    said = ",".join([p[0] for p in pieces])
                    n.append(sum([p[1] for p in pieces]))
                    sha.append(hashlib.sha256(said.encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join([p[2] for p in pieces]).decode("utf-8", "replace").encode("utf-8")).hexdigest())
                    if with_ids:
                        ids.append(numbers(said))
                out = {"doc_id": b.column("doc_id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
                if with_ids:
                    out["ids"] = pa.array(ids, pa.list_(pa.int32()))
                if with_row:
                    out["row"] = b.column("row")
                yield pa.record_batch(list(out.values()), names=list(out))

    return run


def tokenise(docs: DataFrame, path: str, pattern: str, ids: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; the ids and the struct ``row`` on demand.

    ``path`` is the vocabulary file, which every executor must have at that place; ``pattern`` splits text.
    """
    bounded_batches(docs.sparkSession)
    row = [F.struct(*keep).alias("row")] if keep else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *row)
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    kind += ", ids array<int>" * ids + (f", row {rows.schema['row'].dataType.simpleString()}" if keep else "")
    return rows.mapInArrow(_encode(path, pattern, ids, bool(keep)), kind)


def default_vocabulary() -> tuple[str, str]:
    """(path, pattern) of the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
