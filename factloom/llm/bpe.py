"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never lie within a token, so every place where
such a pair stands in a text is a certain token boundary.  The tokeniser also splits by a pattern before
it merges, and that split may not change when a text is cut.  A cut is left out if a fragment could then end in white
space (the pattern looks ahead there), begin with an apostrophe that stood in a run of signs (the pattern knows contractions), or begin within a
character.  All other pairs that no token holds are cuts, within words too.

Fragments between cuts are encoded independently and concatenated.  A direct-mapped cache of fragments of up to 15 bytes, which are
exact keys of two numbers, is read for a whole chunk of documents at once; only fragments that it lacks are encoded.
Decoding gathers the token bytes of the ids and reads them as UTF-8.

Nulls and empty texts give no ids and an empty decoded text; the special token's string in a text is that token.  Repeated rows give
repeated results.  A text of any length is one chunk; memory follows the longest text.  Ids of any type and other columns are left alone.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import SPACE, U64, doc_chunks, mix

#: Slots of a worker's cache; ids that it holds before it is emptied; bytes of text that are encoded at once.
SLOTS, POOL, CHUNK = 1 << 19, 12_000_000, 1 << 19
_loaded: dict[str, "Codec"] = {}
#: Bits of a key's first and second number that hold the bytes of a fragment of each length.
_MASKS = np.array([[(1 << 8 * min(k, 8)) - 1, (1 << 8 * max(0, k - 8)) - 1] for k in range(16)], U64)
#: First and last bytes of the UTF-8 forms of white space beyond ASCII.
_SPACE_FORMS = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_SPACE_LEADS, _SPACE_ENDS = sorted({x[0] for x in _SPACE_FORMS}), sorted({x[-1] for x in _SPACE_FORMS})
_SPACE_LIST = SPACE.tolist()


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in for each byte: printable Latin-1 stands for itself, others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def allowed_cuts() -> np.ndarray:
    """[a, b]: a cut between bytes a and b leaves the pattern's split of either side as it is."""
    code = np.arange(256)
    word = (code >= 48) & (code <= 57) | (code >= 65) & (code <= 90) | (code >= 97) & (code <= 122)
    last = (code > 32) & (code < 127) | (code >= 0x80) & (code < 0xC0) & ~np.isin(code, _SPACE_ENDS)
    first = (code < 128) | (code >= 0xC2)
    ok = last[:, None] & first[None, :]
    ok[~word, 39] = False
    # control characters other than white space are left alone
    odd = (code < 32) & ~SPACE | (code == 127)
    ok[:, odd] = False
    return ok


class Codec:
    """A tokenizers file with its byte table, cut table and fragment cache."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        letters = byte_alphabet()
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        vocab = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        vocab |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        size = max(vocab) + 1
        tokens = [vocab.get(i, b"") for i in range(size)]
        self.token_len = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)])[:-1]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        inside = np.zeros((256, 256), bool)
        for t in tokens:
            if len(t) > 1:
                a = np.frombuffer(t, np.uint8)
                inside[a[:-1], a[1:]] = True
        self.fast = self._merger(spec)
        #: cut[a, b]: a text may be cut between bytes a and b.  Other pre-tokenisers are only known to split before ASCII white space.
        self.cut = ~inside & allowed_cuts() & (True if self.fast is not None else SPACE[None, :])
        self.special_pattern = re.compile(b"|".join(map(re.escape, self.special)) or b"(?!)")
        #: The id of a line end, last bytes that may stand before one, first bytes that are no white space.
        line = self.fast("\n") if self.fast is not None else []
        self.line = line[0] if len(line) == 1 else None
        self.before_line = self.cut[:, 10].tolist()
        self.plain = (~SPACE & ~np.isin(np.arange(256), _SPACE_LEADS)).tolist()
        self.long: dict[bytes, tuple[int, int]] = {}
        self._empty()

    def _empty(self) -> None:
        #: A slot: both numbers of the key, where its ids begin in the pool, how many they are.
        self.slots = np.zeros((SLOTS, 4), U64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.long.clear()

    def _merger(self, spec: dict):
        """The same vocabulary and merge ranks in tiktoken, which encodes one fragment with less overhead."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or spec.get("normalizer") or model.get("dropout"):
            return None
        letters = byte_alphabet()
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [model["vocab"].get(a + b) for a, b in merged]
        if None in ids or any(x >= y for x, y in zip(ids, ids[1:])) or len(set(ids)) + 256 != len(ranks):
            return None  # tiktoken merges by id order; that must be the order of the merges
        import tiktoken

        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the pattern of a ByteLevel pre-tokeniser
        return tiktoken.Encoding("fragments", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def _alone(self, fragment: bytes) -> list[int]:
        text = fragment.decode("utf-8")
        if self.fast is not None and not self.special_pattern.search(fragment):
            return self.fast(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def _encoded(self, fragments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments one after another, and how many each has.

        Fragments that begin with at most one white space and end in none go through one call, with line ends between them.
        """
        out: list = [None] * len(fragments)
        together = []
        if self.line is not None:
            last, plain, space, special = self.before_line, self.plain, _SPACE_LIST, self.special_pattern.search
            together = [k for k, x in enumerate(fragments) if last[x[-1]] and (plain[x[0]] or space[x[0]] and len(x) > 1 and plain[x[1]]) and not special(x)]
        if together:
            some = [fragments[k] for k in together]
            ids = np.array(self.fast(b"\n".join(some).decode("utf-8")), np.uint32)
            ends = np.cumsum(self.token_len[ids])
            size = np.array([len(x) for x in some])
            begin = np.cumsum(size + 1) - (size + 1)
            lo, hi = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, begin + size, "right")
            lo[0] = 0
            if not (ends[hi - 1] == begin + size).all() or not (ids[hi[:-1]] == self.line).all():
                raise AssertionError("a token spans a forced boundary")
            for k, a, z in zip(together, lo.tolist(), hi.tolist()):
                out[k] = ids[a:z]
        for k, x in enumerate(out):
            if x is None:
                out[k] = np.array(self._alone(fragments[k]), np.uint32)
        return np.concatenate(out) if out else np.zeros(0, np.uint32), np.array([len(x) for x in out], np.int64)

    def _store(self, fragments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encode fragments into the pool: where each one's ids begin, and how many they are."""
        ids, n = self._encoded(fragments)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.append(self.pool[: self.used], np.zeros(self.used + len(ids), np.uint32))
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n
        self.used += len(ids)
        return at, n

    def encode_ids(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all documents one after another, and where each document's begin."""
        n = len(buf)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        edge = np.zeros(n + 1, bool)
        edge[1:n] = self.cut[buf[:-1], buf[1:]]
        edge[offs] = True
        cuts = np.flatnonzero(edge)
        starts, size = cuts[:-1], np.diff(cuts)
        if self.used > POOL:
            self._empty()
        padded = np.concatenate([buf, np.zeros(16, np.uint8)])
        eight = np.ndarray((n + 9,), np.dtype("<u8"), padded, 0, (1,))
        short = np.minimum(size, 15)
        # whole bytes and the length: an exact key of a fragment of up to 15 bytes
        k1, k2 = eight[starts] & _MASKS[short, 0], eight[starts + 8] & _MASKS[short, 1] | short.astype(U64) << U64(56)
        with np.errstate(over="ignore"):
            h = mix(k1 * U64(0x9E3779B97F4A7C15) + k2)
        slot = (h & U64(SLOTS - 1)).astype(np.int64)
        held = self.slots.take(slot, 0)
        known = (held[:, 0] == k1) & (held[:, 1] == k2)
        at, count = held[:, 2].astype(np.int64), held[:, 3].astype(np.int64)
        known[size > 15] = False
        miss = np.flatnonzero(~known)
        if len(miss):
            data = buf.tobytes()
            near = miss[size[miss] <= 15]
            by = near[np.argsort(h[near])]
            new = np.append(True, (k1[by[1:]] != k1[by[:-1]]) | (k2[by[1:]] != k2[by[:-1]]))[: len(by)]
            one = by[new]
            a, c = self._store([data[x:y] for x, y in zip(starts[one].tolist(), (starts[one] + size[one]).tolist())])
            group = np.cumsum(new) - 1
            at[by], count[by] = a[group], c[group]
            self.slots[slot[one]] = np.stack([k1[one], k2[one], a.view(U64), c.view(U64)], 1)
            far = miss[size[miss] > 15]
            if len(far):
                texts = [data[x:y] for x, y in zip(starts[far].tolist(), (starts[far] + size[far]).tolist())]
                fresh = [x for x in dict.fromkeys(texts) if x not in self.long]
                self.long.update(zip(fresh, zip(*(x.tolist() for x in self._store(fresh)))))
                at[far], count[far] = np.array([self.long[x] for x in texts]).T
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.arange(total[-1]) + np.repeat(at - total[:-1], count)]
        return ids, total[np.searchsorted(cuts, offs)]

    def encode_chunk(self, buf: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of each document as unsigned 32-bit integers."""
        ids, at = self.encode_ids(buf, offs)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield ids[a:b]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that the ids stand for; broken sequences become U+FFFD."""
        if not len(ids):
            return b""
        lens = self.token_len[ids]
        ends = np.cumsum(lens)
        raw = self.token_bytes[np.arange(ends[-1]) + np.repeat(self.token_at[ids] - (ends - lens), lens)].tobytes()
        try:
            raw.decode("utf-8")
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode("utf-8")


def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    if path not in _loaded:
        _loaded[path] = Codec(path)
    return _loaded[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): token ids of each whole text as an integer list."""

    def run(batches):
        c = codec(tokenizer)
        for batch in batches:
            for i, j, buf, offs in doc_chunks(batch.column(1), CHUNK):
                ids, at = c.encode_ids(buf, offs)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(at)), lists], ["id", "n_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n_tokens long, ids array<int>").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) of rows with an ``ids`` list; null or empty lists give an empty text."""

    def run(batches):
        c = codec(tokenizer)
        for batch in batches:
            texts = [c.decode(np.array(x or [], np.int64)).decode("utf-8") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return coded.select(F.col(id_col).cast("long").alias("k"), "ids").mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass without moving the ids: id, n_tokens, digests of ids and decoded text."""

    def run(batches):
        c = codec(tokenizer)
        for batch in batches:
            counts, a, b = [], [], []
            for _, _, buf, offs in doc_chunks(batch.column(1), CHUNK):
                for ids in c.encode_chunk(buf, offs):
                    counts.append(len(ids))
                    a.append(hashlib.sha256(ids.astype("<u4", copy=False)).hexdigest())
                    b.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
