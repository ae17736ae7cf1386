"""Byte-level BPE with the tokenizers library over Arrow batches.

Every byte stands for one character (the usual byte-to-character table), so a
vocabulary of byte strings becomes one of character strings that the library's
BPE model can hold. Encoding gives ids as little-endian unsigned 32-bit
integers in a binary column, and optionally character offsets; decoding maps
ids back to byte strings and joins them, so a character split over several
tokens comes back whole.

Many words of a corpus repeat. A text is cut at single spaces, before a stop or
comma that ends a word, and around single line breaks, where every pattern of
this family has a token border; Arrow cuts and numbers the pieces of a batch,
and only different pieces not seen lately reach the library. Their ids are kept
in a task's bounded cache. Texts with other white space around a space are
encoded in one go.

Defined results: null counts as the empty text and has no ids; special-token
strings inside a text are ordinary text; ids outside the vocabulary cannot be
decoded and raise.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import map_batches, pieces, utf8, worker_table

#: Pieces whose ids a task keeps (about 30 MB); the cache goes with the task.
CACHE_PIECES = 700_000
#: Pieces sent to the library in one call.
CALL_PIECES = 20_000
#: Pieces whose ids are put in place at a time.
GATHER_PIECES = 1 << 20
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"  # letters in every Unicode version
MARKS = ".,;:!?*$%&#-"
#: Put before a piece that no space precedes; texts that hold it are encoded in one go, so it also ends pieces in a call.
BARE = "\x01"
#: Stands for a space that belongs to a piece while plain spaces part the library's words.
LEAD = "\x02"
#: White space as Python's and Unicode's patterns see it (Arrow's own class has ASCII only).
WHITE = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT_UNSAFE = rf"[{WHITE}] [{WHITE}]|{BARE}"
#: Arrow patterns have no look-around: a line break shares its neighbours with the next one, so its cut runs twice.
_LINE = (rf"([^{WHITE}])\n([^{WHITE}])", f"\\1 {BARE}\n {BARE}\\2")
_CUTS = [(rf"([{LETTERS}])([.,])([ \n]|\z)", rf"\1 {BARE}\2\3"), _LINE, _LINE]
#: Pieces of letters and marks are cut into the pattern's words by where the two kinds meet.
_PLAIN = rf"\A{BARE}?[{LETTERS}{MARKS}]+\z"
_MEET = [(rf"([{LETTERS}])([{MARKS}])", r"\1 \2"), (rf"([{MARKS}])([{LETTERS}])", r"\1 \2")]


def byte_chars() -> list[str]:
    """The character of each byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    spare = iter(range(0x100, 0x200))
    return [table[b] if b in table else chr(next(spare)) for b in range(256)]


CHARS = byte_chars()
BYTES = {c: b for b, c in enumerate(CHARS)}
#: Byte to character, for words parted by plain spaces.
_MAPPED = [CHARS[0x20] if b == ord(LEAD) else " " if b == 0x20 else c for b, c in enumerate(CHARS)]


def to_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(CHARS)


def to_bytes(token: str) -> bytes:
    return bytes(BYTES[c] for c in token)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def model_of_ranks(ranks: dict[bytes, int]):
    """BPE model whose merges join any two tokens that together are a token, lowest rank first."""
    from tokenizers import models
    chars = {t: to_chars(t) for t in ranks}
    merges = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        for cut in range(1, len(token)):
            left, right = token[:cut], token[cut:]
            if left in ranks and right in ranks:
                merges.append((chars[left], chars[right]))
    return models.BPE(vocab={chars[t]: r for t, r in ranks.items()}, merges=merges)


def load(path: str):
    """(tokenizer, byte string of each id) of a ``.tiktoken`` rank file or a tokenizers ``.json`` file, kept by the worker."""
    return worker_table(("vocabulary", path), lambda: read_vocabulary(path))


def read_vocabulary(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers
    if path.endswith(".json"):
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        special = {i for i, t in tokenizer.get_added_tokens_decoder().items()}
        table = {i: t.encode() if i in special else to_bytes(t) for t, i in tokenizer.get_vocab().items()}
    else:
        ranks = read_ranks(path)
        tokenizer = Tokenizer(model_of_ranks(ranks))
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        table = {r: t for t, r in ranks.items()}
    return tokenizer, [table.get(i) for i in range(max(table) + 1)]


def cut_pieces(texts: pa.Array) -> pa.ListArray:
    """The pieces of each text; a piece that no space precedes is marked ``BARE``, the others follow a space."""
    for pattern, mark in _CUTS:
        texts = pc.replace_substring_regex(texts, pattern, mark)
    return pc.split_pattern(pc.binary_join_element_wise(BARE, texts, ""), " ")


def gather(ids: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> Iterator[np.ndarray]:
    """``ids`` holds a run of ``sizes[k]`` ids per k; yields the runs that ``index`` names, in order, in blocks."""
    starts = np.cumsum(sizes) - sizes
    for at in range(0, len(index), GATHER_PIECES):
        block = index[at:at + GATHER_PIECES]
        n = sizes[block]
        ends = np.cumsum(n)
        yield ids[np.arange(ends[-1]) + np.repeat(starts[block] - (ends - n), n)]


class PieceEncoder:
    """Ids of texts, each as little-endian unsigned 32-bit integers.

    Arrow cuts a batch of texts into pieces and numbers the different ones;
    those not kept from before go to the library, and numpy puts the ids of all
    in place. Past ``capacity`` the pieces not seen for longest are forgotten.
    """

    def __init__(self, path: str, capacity: int = CACHE_PIECES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, table = load(path)
        self.words = Tokenizer(self.tokenizer.model)   # words given in mapped characters, one space between
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.spaced = np.array([bool(t) and t.startswith(b" ") for t in table])
        self.end = table.index(BARE.encode())
        self.capacity = capacity
        self.known = pa.array([], pa.string())
        self.ids = np.empty(0, "<u4")                  # of all known pieces, one after the other
        self.sizes = np.empty(0, np.int64)
        self.seen = np.empty(0, np.int64)              # the batch that had the piece last
        self.batch = 0

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.string()).fill_null("")
        unsafe = pc.match_substring_regex(texts, _SPLIT_UNSAFE)
        cut = iter(self._cut_encode(texts.filter(pc.invert(unsafe))))
        whole = iter(self._plain_encode(texts.filter(unsafe).to_pylist()))
        return [(next(whole) if u else next(cut)).tobytes() for u in unsafe.to_pylist()]

    def _plain_encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4")
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _cut_encode(self, texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        cut = cut_pieces(texts)
        coded = cut.flatten().dictionary_encode()
        index = self._places(coded.dictionary)[coded.indices.to_numpy()]
        ids = np.concatenate(list(gather(self.ids, self.sizes, index)))
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        ends = np.concatenate([[0], np.cumsum(self.sizes[index])])[bounds].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def _places(self, different: pa.Array) -> np.ndarray:
        """Where pieces that are all different stand among the known ones, after learning the new ones."""
        self.batch += 1
        at = pc.index_in(different, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        self.seen[at[at >= 0]] = self.batch
        if len(self.known) + int((at < 0).sum()) > self.capacity:
            moved = self._forget()
            at = np.where(at < 0, -1, moved[at]) if len(moved) else at
        new = np.flatnonzero(at < 0)
        fresh = different.take(pa.array(new))
        plain = pc.match_substring_regex(fresh, _PLAIN)
        bare = pc.and_(plain, pc.starts_with(fresh, BARE))
        kinds = [pc.and_not(plain, bare), bare, pc.invert(plain)]
        ordered = np.concatenate([new[k.to_numpy(zero_copy_only=False)] for k in kinds])
        at[ordered] = len(self.known) + np.arange(len(ordered))
        spaced, bare, others = map(fresh.filter, kinds)
        learnt = [(self.ids, self.sizes), *self._learn(spaced, False), *self._learn(bare, True), self._learn_others(others)]
        self.ids, self.sizes = (np.concatenate(x) for x in zip(*learnt))
        self.known = pa.concat_arrays([self.known, different.take(pa.array(ordered))])
        self.seen = np.concatenate([self.seen, np.full(len(ordered), self.batch)])
        return at

    def _forget(self) -> np.ndarray:
        """Keeps this batch's pieces and those of the latest before it, up to half the capacity; returns the new places."""
        since = np.cumsum(np.bincount(self.seen, minlength=self.batch + 1)[::-1])[::-1]   # pieces had by batch k or later
        keep = self.seen >= min(int(np.searchsorted(-since, -(self.capacity // 2))), self.batch)
        kept = np.flatnonzero(keep)
        moved = np.cumsum(keep) - 1
        self.ids = np.concatenate([np.empty(0, "<u4"), *gather(self.ids, self.sizes, kept)])
        self.known = self.known.take(pa.array(kept))
        self.sizes, self.seen = self.sizes[kept], self.seen[kept]
        return moved

    def _learn(self, found: pa.Array, bare: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and sizes of pieces of letters and marks, by the pattern's words in mapped characters.

        Of a piece that follows a space exactly the first token begins with it; a bare piece gets an end of its own.
        """
        for pattern, mark in _MEET:
            found = pc.replace_substring_regex(found, pattern, mark)
        for at in range(0, len(found), CALL_PIECES):
            part = found.slice(at, CALL_PIECES).to_pylist()
            line = f" {BARE} ".join([p[1:] for p in part] + [""]) if bare else LEAD + f" {LEAD}".join(part)
            mapped = line.encode().decode("latin-1").translate(_MAPPED)
            ids = np.array(self.words.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, "<u4")
            if bare:
                ends = ids == self.end
                yield ids[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1
            else:
                yield ids, np.diff(np.flatnonzero(self.spaced[ids]), append=len(ids))

    def _learn_others(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = self._plain_encode([p[1:] if p[:1] == BARE else " " + p for p in found.to_pylist()])
        return np.concatenate([np.empty(0, "<u4"), *ids]), np.array([len(x) for x in ids], np.int64)


def char_offsets(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of each token in the text, from the tokens' byte lengths.

    A token that holds only a part of a character spans that character.
    """
    data = np.frombuffer(text, np.uint8)
    begins = (data & 0xC0) != 0x80
    index = np.concatenate([[0], np.cumsum(begins)])   # characters begun before each byte
    ends = np.cumsum(lengths)
    starts = ends - lengths
    first = np.where(begins[np.minimum(starts, max(len(data) - 1, 0))], index[starts], index[starts] - 1) \
        if len(data) else starts
    return first.astype(np.int64), index[ends].astype(np.int64)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = False) -> DataFrame:
    """``id_col``, n_tokens, ids (binary) and, if asked for, starts and ends (arrays of character offsets)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, table = PieceEncoder(path), load(path)[1]
        sizes = np.array([len(t or b"") for t in table], np.int64)
        for whole in batches:
            for batch in pieces(whole, "text", 6 << 20):
                ids = enc.encode(batch.column(1))
                cols = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["id", "n_tokens", "ids"]
                if offsets:
                    texts = utf8(batch, "text")
                    spans = [char_offsets(t, sizes[np.frombuffer(x, "<u4")]) for t, x in zip(texts, ids)]
                    cols += [pa.array([s[k] for s in spans], pa.list_(pa.int64())) for k in (0, 1)]
                    names += ["starts", "ends"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = dict(df.dtypes)[id_col]
    more = ", starts array<bigint>, ends array<bigint>" if offsets else ""
    narrow = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (map_batches(narrow, run, f"id {kind}, n_tokens bigint, ids binary{more}", ("vocabulary", path))
            .withColumnRenamed("id", id_col))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ``ids_col`` stands for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = load(path)[1].__getitem__
        for whole in batches:
            for batch in pieces(whole, ids_col):
                ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
                found = [b"".join(map(look, np.frombuffer(x or b"", "<u4").tolist())) for x in ids]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())],
                                                 names=[*batch.schema.names, out_col])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"`{out_col}` binary"])
    return map_batches(df, run, schema, ("vocabulary", path))
