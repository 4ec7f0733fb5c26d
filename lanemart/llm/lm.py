"""Language-model scoring with an Elias-Fano n-gram trie, sharded so that it grows with the corpus.

The model is a back-off trigram model with absolute discounting. It never exists in one place: its trie is cut
into shards by the hash of an n-gram's middle word, and every n-gram of every text, training or not, travels to
its shard once, in compressed blocks. A shard counts the distinct training n-grams among them, writes its part of the
trie (``elias_fano.Trie``: monotone pointers and sequences, quantised smoothed probabilities) as one file of the
folder, maps that file and answers all n-grams by context-relative successor search. What falls through to
single words travels on, to shards of the unigram counts, kept in files as well. The folder is the model: ``score_by`` scores
texts that were not there when it was made.

1. ``trigrams`` (per batch of texts): distinct (before, first, last) with the texts they are in -> shard of first.
2. ``answers`` (per shard): its trie; sums of log probabilities per text -> part of the text's batch; last words that were
   not seen after their context -> shard of the word.
3. ``words`` (per batch): distinct words with the texts they are in -> shard of the word.
4. ``counts`` (per shard): unigram counts and, from them, what texts and fallen words get -> part of the batch.
5. ``sums`` (per part): one row per text of a batch; rows of one key are added up.

Scores do not depend on how rows are dealt, to the last bit: a probability depends on the counts of its context only, and
logarithms are multiples of 2^-11 (an error of 0.00025 at most), whose sums are exact in any order. A shard holds its
blocks compressed and unpacks some at a time. All n-grams with one middle word are in one shard, so the shard of
the commonest word grows with its share of the corpus.

Every block is made by one task from its own rows and names texts by their batch, itself named by its texts in order, and
their number there; the keys of a batch's texts travel once. Should a lost task be run again with its rows in another order
after others have read what it sent, sums may lack the keys of their batch, which is an error, never another result.
Nothing is broadcast; the numbers of shards follow from the bytes of text (``SHARD_BYTES``). Blocks aggregate within a batch, so a word or n-gram that is everywhere
costs one entry per batch and text, not one per occurrence.

Words are known by 64-bit hashes of their bytes; two of ten million words share one with a probability of about
10^-6. In trigram blocks the upper 48 bits stand for a word: there a mistake takes two such words after the same
word, and touches only their score.

Tokens of a text: its words ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z, then one end.
P(w | u v) is (c(u v w) - D) / c(u v) if the trigram was seen, else the context's back-off weight times P(w | v);
P(w | v) is (c(v w) - D) / c(v) if the bigram was seen, else D * kinds(v) / c(v) times P(w);
P(w) is (c(w) + 1) / (N + V + 1). Contexts that were not seen are left out. The bigram's back-off weight is not
divided by the unigram mass of unseen words, which would have to travel back; so probabilities sum to at most 1.

Defined cases: null text counts as empty and has one token, its end. A null id counts as empty text when rows are
held out. Repeated rows count once each in training and get equal scores. Without training rows N and V are 0 and
every word has probability 1. An empty table gives an empty result. Further columns do not matter. Very long
texts are read in pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.llm import mapped
from lanemart.llm.common import cut, forget, remove, shared_folder, text_batches
from lanemart.llm.elias_fano import STEP, Trie, Words, numbered, runs

#: Bytes of text per shard of the trie, of the unigrams, and per part of the sums.
SHARD_BYTES, WORD_BYTES, PART_BYTES = 16 << 20, 64 << 20, 64 << 20
#: Tokens that a task numbers, sorts and sends at a time, and those of a batch: the more a batch has, the fewer blocks repeat its words.
GATHER, BATCH = 600_000, 5_000_000
#: N-grams, with the texts that have them, that a shard answers at a time.
RANGE = 400_000
#: Bytes of text hashed at a time.
PIECE = 4 << 20
DISCOUNT = 0.75

BEGIN, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_UPPER = np.uint64(0xFFFF_FFFF_FFFF_0000)
_PRIME = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every bit depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A number for every byte: that of a-z for A-Z, 0 for white space."""
    own = np.arange(256, dtype=np.uint64)
    own[0x41:0x5B] += np.uint64(0x20)
    values = _mix(own + np.uint64(1)) | np.uint64(1)
    values[[0x20, *range(0x09, 0x0E)]] = 0
    return values


_VALUES = _byte_values()


class Hasher:
    """Hashes of the words of texts, by prefix sums of a polynomial over their bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            n = 1 << (n - 1).bit_length()
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - 1, p)))) for p in (_PRIME, _INVERSE))

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, start offsets) of the words of some bytes."""
        values = _VALUES[np.frombuffer(data, dtype=np.uint8)]
        inside = np.concatenate(([False], values != 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edges[::2], edges[1::2]
        self._powers(len(values) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)])))
        return _mix((sums[stops] - sums[starts]) * self.down[starts] + (stops - starts).astype(np.uint64)), starts


def _pieces(text: str) -> Iterator[bytes]:
    """The bytes of a text, cut at white space where it is longer than a piece."""
    data, at = text.encode(), 0
    while len(data) - at > PIECE:
        end = _space(data, at)
        yield data[at:end]
        at = end
    yield data[at:]


def _space(data: bytes, at: int) -> int:
    """The last white space within a piece, or else the first one behind it."""
    window = np.flatnonzero(_VALUES[np.frombuffer(data, np.uint8, PIECE, at)] == 0)
    if len(window) and window[-1]:
        return at + int(window[-1])
    ends = [p for p in (data.find(c, at + PIECE) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) if p >= 0]
    return min(ends, default=len(data))


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block: ascending ones as differences, and bytes of equal weight together."""
    parts = []
    for name, a in arrays.items():
        if a.dtype.kind == "u" and len(a) > 1 and (a[1:] >= a[:-1]).all():
            name, a = f"+{name}", np.concatenate((a[:1], a[1:] - a[:-1]))
        octets, head = np.ascontiguousarray(a).view(np.uint8), f"{name} {a.dtype.str} {len(a)}".encode()
        parts += [len(head).to_bytes(2, "little"), head, *(octets[k :: a.dtype.itemsize].tobytes() for k in range(a.dtype.itemsize))]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(block: bytes) -> dict[str, np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(block), 0, {}
    while at < len(data):
        n = int.from_bytes(data[at : at + 2], "little")
        name, kind, size = data[at + 2 : at + 2 + n].decode().split()
        at, size, width = at + 2 + n, int(size), np.dtype(kind).itemsize
        octets = np.empty(size * width, dtype=np.uint8)
        for k in range(width):
            octets[k::width] = np.frombuffer(data, np.uint8, size, at + k * size)
        values = octets.view(kind)
        out[name.lstrip("+")] = np.cumsum(values, dtype=values.dtype) if name[0] == "+" else values
        at += size * width
    return out


def _small(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the upper bits, so sorted hashes are sorted by shard; at most 2^24 shards."""
    return ((hashes >> np.uint64(24)) * np.uint64(shards) >> np.uint64(40)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens of many texts together: (hashes of words in order, each token's place among them, number of its text, text keys,
    training flags).

    Words are numbered ``GATHER`` tokens at a time, so that a token takes eight bytes until ``BATCH`` of them are sent.
    """
    hasher, tokens, sizes, keys, flags, size = Hasher(), [], [], [], [], 0
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    total = 0

    def number() -> None:
        words, places = numbered(np.concatenate(tokens))
        parts.append((words, places.astype(np.int32)))
        tokens.clear()

    def gathered():
        if tokens:
            number()
        words, places = numbered(np.concatenate([w for w, _ in parts]))
        places = np.split(places.astype(np.int32), np.cumsum([len(w) for w, _ in parts])[:-1])
        w = np.concatenate([p[own] for p, (_, own) in zip(places, parts)])
        owner = np.repeat(np.arange(len(keys), dtype=np.int32), sizes)
        return words, w, owner, np.array(keys, dtype=np.int64).view(np.uint64), np.array(flags, dtype=bool)

    for batch in batches:
        for key, text, flag in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            own = [hasher.words(piece)[0] for piece in _pieces(text.as_py() or "")]
            tokens += [*own, np.array([END])]
            sizes.append(sum(map(len, own)) + 1)
            keys.append(key)
            flags.append(flag)
            size += sizes[-1]
            total += sizes[-1]
            if size >= GATHER:
                number()
                size = 0
            if total >= BATCH:
                yield gathered()
                parts, sizes, keys, flags, size, total = [], [], [], [], 0, 0
    if keys:
        yield gathered()


def _slices(w: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The positions of tokens by ranges of their ``n`` words, about ``GATHER`` tokens at a time."""
    at = np.cumsum(np.bincount(w, minlength=n)) // GATHER
    for a, b in zip(starts := runs(at), [*starts[1:], n]):
        yield np.flatnonzero((w >= a) & (w < b))


def _batch_id(keys: np.ndarray, flags: np.ndarray) -> np.uint64:
    """A batch's name, by its texts in order: a text is its batch and its number there, which take less room than its key."""
    return np.frombuffer(hashlib.blake2b(keys.tobytes() + flags.tobytes(), digest_size=8).digest(), np.uint64)[0]


def _keys_block(batch: np.uint64, keys: np.ndarray, shards: int) -> tuple[int, bytes]:
    """The keys of a batch's texts, sent once; what texts get is sent by their numbers, and meets the keys in ``sums``."""
    own = np.array([batch])
    return int(shard_of(own, shards)[0]), _pack(batch=own, keys=keys)


def _blocks(grams: tuple[np.ndarray, ...], names: tuple[str, ...], owner: np.ndarray, words: np.ndarray, shards: int, batch, flags):
    """Blocks by shard of n-grams given as numbers of words; the first of an n-gram decides on its shard.

    A block has the hashes of its words, its distinct n-grams in order, and its entries: an n-gram, a text that
    has it, and how many times.
    """
    bits = int(len(words)).bit_length()
    if bits * len(grams) < 64:
        key = np.zeros(len(owner), dtype=np.uint64)
        for g in grams:
            key = (key << np.uint64(bits)) | g.astype(np.uint64)
        order = np.argsort(key)
    else:
        order = np.lexsort(grams[::-1])
    grams = tuple(g[order] for g in grams)
    distinct = runs(*grams)
    of = np.zeros(len(owner), dtype=np.uint64)
    of[distinct[1:]] = 1
    pair = np.sort((np.cumsum(of, dtype=np.uint64) << np.uint64(32)) | owner[order].astype(np.uint64))
    entries = runs(pair)
    times = np.diff(np.concatenate((entries, [len(pair)])))
    of, owner = (pair[entries] >> np.uint64(32)).astype(np.int64), (pair[entries] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fields = {n: g[distinct] for n, g in zip(names, grams)}
    shard = shard_of(words[fields[names[0]]], shards)
    place = np.zeros(max(len(words), len(flags)), dtype=np.int64)

    def local(size: int, *arrays: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The numbers that the arrays use, and the arrays by places among those."""
        mark = np.zeros(size, dtype=bool)
        for a in arrays:
            mark[a] = True
        used = np.flatnonzero(mark)
        place[used] = np.arange(len(used))
        return used, [_small(place[a]) for a in arrays]

    for a, b in zip(starts := runs(shard), [*starts[1:], len(shard)]):
        lo, hi = np.searchsorted(of, [a, b])
        used, own = local(len(words), *(f[a:b] for f in fields.values()))
        owners, (mine,) = local(len(flags), owner[lo:hi])
        block = {"words": words[used], **dict(zip(names, own)), "of": _small(of[lo:hi] - a), "owner": mine, "times": _small(times[lo:hi])}
        yield int(shard[a]), _pack(**block, batch=np.full(len(owners), batch), text=owners.astype(np.uint32), flags=flags[owners].view(np.uint8))


def _release() -> None:
    """Give freed memory back to the system: a worker is used again, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _sent(kind: str, rows) -> Iterator[pa.RecordBatch]:
    for shard, block in rows:
        yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([shard], pa.int64()), pa.array([block], pa.binary())], names=["kind", "shard", "block"])


_SENT = "kind string, shard long, block binary"


def _trigram_blocks(rows: DataFrame, shards: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, w, owner, keys, flags in _batches(batches):
            words, places = numbered(np.concatenate(([BEGIN], hashes)) & _UPPER)
            begin, w = places[0], places[1:].astype(np.int32)[w]
            batch = _batch_id(keys, flags)
            yield from _sent("names", [_keys_block(batch, keys, shards)])
            first = np.concatenate(([True], owner[1:] != owner[:-1]))
            one = np.where(first, begin, np.roll(w, 1)).astype(np.int32)
            for at in _slices(one, len(words)):
                two = np.where(first[at], begin, one[at - 1])
                yield from _sent("trigrams", _blocks((one[at], two, w[at]), ("first", "before", "last"), owner[at], words, shards, batch, flags))
                _release()
            del hashes, w, owner, places, first, one, two, words

    return rows.mapInArrow(each, _SENT)


def _word_blocks(rows: DataFrame, shards: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, w, owner, keys, flags in _batches(batches):
            batch = _batch_id(keys, flags)
            yield from _sent("names", [_keys_block(batch, keys, shards)])
            for at in _slices(w, len(words)):
                yield from _sent("words", _blocks((w[at],), ("word",), owner[at], words, shards, batch, flags))
                _release()
            del words, w, owner

    return rows.mapInArrow(each, _SENT)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[str, bytes]]]]:
    """The blocks of a task by their shard, as they came; a task without any has an empty shard."""
    found: dict[int, list] = {}
    for batch in batches:
        for kind, shard, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            found.setdefault(shard, []).append((kind, block.as_py()))
    if not found:
        yield TaskContext.get().partitionId(), []
    while found:
        yield found.popitem()


def _meet(blocks: DataFrame, shards: int) -> DataFrame:
    """All blocks of a shard in the task of its number, and nothing else there."""
    return text_batches(blocks.repartitionById(shards, F.col("shard").cast("int")))


def _training(blocks: list[bytes], names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(hashes of words, distinct n-grams of training texts by places among them, counts) of a shard, in order."""
    words, grams, counts = [], [], []
    for block in blocks:
        b = _unpack(block)
        number = np.bincount(b["of"], b["times"] * b["flags"][b["owner"]], len(b[names[0]]))
        own = np.flatnonzero(number)
        used, places = numbered(np.concatenate([b[n][own] for n in names]))
        words.append(b["words"][used])
        grams.append([_small(c) for c in np.split(places, len(names))])
        counts.append(number[own].astype(np.uint32))
    if not words:
        return np.zeros(0, np.uint64), [np.zeros(0, np.int64) for _ in names], np.zeros(0)
    hashes, places = numbered(np.concatenate(words))
    places = np.split(places, np.cumsum([len(w) for w in words])[:-1])
    columns = [np.concatenate([p[g[i]] for p, g in zip(places, grams)]) for i in range(len(names))]
    del words, places, grams
    bits = len(hashes).bit_length()
    if bits * len(names) < 64:
        key = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            key = (key << np.uint64(bits)) | c.astype(np.uint64)
        order = np.argsort(key)
    else:
        order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    starts = runs(*columns)
    counts = np.concatenate(counts)[order].astype(np.float64)
    return hashes, [c[starts] for c in columns], np.add.reduceat(counts, starts) if len(starts) else counts


def _together(blocks: list[bytes], names: tuple[str, ...]):
    """The n-grams that a shard is asked for, some blocks together, about ``RANGE`` entries at a time.

    For each part: hashes of its words in order, the n-grams by places among them (one column per name), the
    entries as (n-gram, text, times), and the texts' batches and numbers there.
    """
    group, size = [], 0
    for k, block in enumerate(blocks):
        group.append(_unpack(block))
        size += len(group[-1]["of"])
        if size < RANGE and k + 1 < len(blocks):
            continue
        words, places = numbered(np.concatenate([b["words"] for b in group]))
        places = np.split(places, np.cumsum([len(b["words"]) for b in group])[:-1])
        batch, text = (np.concatenate([b[n] for b in group]) for n in ("batch", "text"))
        begin = np.cumsum([0] + [len(b["text"]) for b in group])
        grams = [np.concatenate([p[b[n]] for p, b in zip(places, group)]) for n in names]
        before = np.cumsum([0] + [len(b[names[0]]) for b in group])
        of = np.concatenate([b["of"].astype(np.int64) + n for b, n in zip(group, before)])
        owner = np.concatenate([b["owner"].astype(np.int64) + n for b, n in zip(group, begin)])
        times = np.concatenate([b["times"] for b in group]).astype(np.float64)
        yield words, grams, of, owner, times, batch, text
        group, size = [], 0


def _text_sums(batch: np.ndarray, text: np.ndarray, parts: int, **values: np.ndarray):
    """Blocks by part of the batch of sums per text."""
    for a, b in zip(starts := runs(batch), [*starts[1:], len(batch)]):
        own = np.any([v[a:b] != 0 for v in values.values()], axis=0)
        yield int(shard_of(batch[a : a + 1], parts)[0]), _pack(batch=batch[a : a + 1], text=text[a:b][own], **{n: v[a:b][own] for n, v in values.items()})


def _names(found: list[tuple[str, bytes]], parts: int) -> Iterator[pa.RecordBatch]:
    """The keys of batches, on their way to the parts of the sums."""
    for block in (b for kind, b in found if kind == "names"):
        yield from _sent("names", [(int(shard_of(_unpack(block)["batch"], parts)[0]), block)])


_TRIGRAM = ("first", "before", "last")


def _file(folder: str, kind: str, shard: int) -> str:
    """Where a shard is kept, a thousand files to a folder."""
    return f"{folder}/{kind}-{shard // 1000:05d}/{shard % 1000:03d}"


def _answers(blocks: DataFrame, shards: int, word_shards: int, parts: int, folder: str, discount: float | None, keep: bool) -> DataFrame:
    """What texts get from each shard's trie; with a discount the trie is made first, of the training texts. A trie that is
    not to be kept goes when its shard has answered."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, found in _by_shard(batches):
            own = [b for kind, b in found if kind == "trigrams"]
            yield from _names(found, parts)
            if discount is not None:
                words, grams, counts = _training(own, _TRIGRAM)
                Trie(words, *grams, counts, discount).save(_file(folder, "trigrams", number))
                del words, grams, counts
                _release()
            trie = Trie.open(_file(folder, "trigrams", number))
            for words, grams, of, owner, times, batch, text in _together(own, _TRIGRAM):
                value, open_ = trie.query(words, *grams)
                yield from _sent("sums", _text_sums(batch, text, parts, score=np.bincount(owner, value[of] * times, len(text))))
                at = np.flatnonzero(open_[of])
                yield from _sent("fallen", _fallen_blocks(batch, text, words[grams[2][of[at]]], owner[at], times[at], word_shards))
                del words, grams, of, owner, times, batch, text, value, open_, at
                _release()
            del trie
            if not keep:
                mapped.delete(_file(folder, "trigrams", number))

    return _meet(blocks, shards).mapInArrow(each, _SENT)


def _fallen_blocks(batch: np.ndarray, text: np.ndarray, hashes: np.ndarray, owner: np.ndarray, times: np.ndarray, shards: int):
    """Blocks by shard of words that are to be looked up among single words, and the texts that want them."""
    order = np.argsort(hashes)
    hashes, owner, times = hashes[order], owner[order], times[order].astype(np.uint32)
    shard = shard_of(hashes, shards)
    for a, b in zip(starts := runs(shard), [*starts[1:], len(shard)]):
        words, word = numbered(hashes[a:b])
        owners, mine = numbered(owner[a:b])
        yield int(shard[a]), _pack(words=words, word=_small(word), owner=_small(mine), times=_small(times[a:b]), batch=batch[owners], text=text[owners])


def _counts(blocks: DataFrame, shards: int, parts: int, folder: str, fit: bool) -> DataFrame:
    """Per shard of words: what every text gets from them, and the shard's share of N and V."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, found in _by_shard(batches):
            own = [b for kind, b in found if kind == "words"]
            yield from _names(found, parts)
            if fit:
                hashes, (word,), counts = _training(own, ("word",))
                Words(hashes[word], counts).save(_file(folder, "words", number))
                yield from _sent("total", [(number, _pack(total=np.array([counts.sum(), len(counts)])))])
                del hashes, word, counts
            known = Words.open(_file(folder, "words", number))
            for words, (gram,), of, owner, times, batch, text in _together(own, ("word",)):
                c, size = known.count(words)[gram[of]], len(text)
                yield from _sent("sums", _text_sums(
                    batch, text, parts, base=np.bincount(owner, np.log10(c + 1) * times, size), n_tokens=np.bincount(owner, times, size),
                    n_known=np.bincount(owner, (c > 0) * times, size), rows=np.bincount(owner, (words == END)[gram[of]], size),
                ))
                del words, gram, of, owner, times, batch, text, c
                _release()
            for b in (_unpack(block) for kind, block in found if kind == "fallen"):
                value = np.rint(np.log10(known.count(b["words"], int(_UPPER)) + 1.0) / STEP) * STEP
                texts = {"score": value[b["word"]] * b["times"], "fallen": b["times"].astype(float)}
                texts = {n: np.bincount(b["owner"], v, len(b["text"])) for n, v in texts.items()}
                yield from _sent("sums", _text_sums(b["batch"], b["text"], parts, **texts))

    return _meet(blocks, shards).mapInArrow(each, _SENT)


_SUMS = ("score", "base", "fallen", "n_tokens", "n_known", "rows")


def _sums(blocks: DataFrame, parts: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _by_shard(batches):
            names = {b["batch"][0]: b["keys"] for b in (_unpack(b) for kind, b in found if kind == "names")}
            if not found:
                continue
            begin = dict(zip(names, np.cumsum([0] + [len(k) for k in names.values()])))
            keys, places = numbered(np.concatenate([*names.values()]))
            out = np.zeros((len(_SUMS), len(keys)))
            for b in (_unpack(b) for kind, b in found if kind == "sums"):
                own = places[begin[b["batch"][0]] + b["text"].astype(np.int64)]  # a batch without keys is an error
                for row, name in zip(out, _SUMS):
                    if name in b:
                        np.add.at(row, own, b[name])
            for a in range(0, len(keys), 65_536):
                cuts = slice(a, a + 65_536)
                yield pa.RecordBatch.from_arrays([pa.array(keys[cuts].view(np.int64)), *(pa.array(r[cuts]) for r in out)], names=["key", *_SUMS])

    return _meet(blocks, parts).mapInArrow(each, "key long, " + ", ".join(f"{n} double" for n in _SUMS))


def _scored(keyed: DataFrame, id_column: str, folder: str, model: dict, discount: float | None, keep: bool = True) -> tuple[DataFrame, dict]:
    """Rows with their scores, and the model's figures; with a discount the model is made first."""
    spark, shards, word_shards, parts = keyed.sparkSession, model["shards"], model["word_shards"], model["parts"]
    rows = text_batches(keyed.select("key", "text", "train"))
    answered = cut(_answers(_trigram_blocks(rows, shards), shards, word_shards, parts, folder, discount, keep))
    forget(spark)  # the largest shuffle, which nothing needs from here on
    fallen = answered.filter("kind = 'fallen'")
    counted = cut(_counts(_word_blocks(rows, word_shards).union(fallen), word_shards, parts, folder, discount is not None))
    forget(spark)
    if discount is not None:
        totals = np.zeros(2)
        for r in counted.filter("kind = 'total'").toLocalIterator():
            totals += _unpack(r["block"])["total"]
        model = model | {"tokens": int(totals[0]), "kinds": int(totals[1])}
    sums = _sums(answered.union(counted).filter("kind in ('sums', 'names')"), parts).groupBy("key").agg(*[F.sum(n).alias(n) for n in _SUMS])
    # Equal rows met under one key: each gets its share. An end stands for a row in the blocks of END.
    sums = sums.select("key", *[(F.col(n) / F.greatest("rows", F.lit(1.0))).alias(n) for n in _SUMS])
    below = float(np.log10(model["tokens"] + model["kinds"] + 1))
    out = keyed.select("id", "key").join(sums, "key")
    whole = lambda name: F.round(name).cast("long").alias(name)
    return out.select(
        F.col("id").alias(id_column), whole("n_tokens"), whole("n_known"), F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("score") - whole("fallen") * F.lit(below)).alias("score"),
    ), model


def _keyed(docs: DataFrame, train: Column, id_column: str, text_column: str) -> tuple[DataFrame, int]:
    """(id, text, train, key) of all rows, and the bytes of their texts."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.select(F.col(id_column).alias("id"), text.alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    keyed = keyed.withColumn("key", F.xxhash64("id", "text", "train"))
    return keyed, int(keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def score(
    docs: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text", discount: float = DISCOUNT, folder: str | None = None
) -> DataFrame:
    """Per row its id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Rows for which ``train`` holds teach the model; all rows are scored. The model stays in ``folder``, a new one that all
    executors reach, for ``score_by``; without one its files lie in the shared folder until their n-grams are answered.
    """
    spark = docs.sparkSession
    keyed, size = _keyed(docs, train, id_column, text_column)
    place = folder or f"{shared_folder(spark).rstrip('/')}/lm-{uuid.uuid4().hex}"
    model = {n: 1 + size // b for n, b in (("shards", SHARD_BYTES), ("word_shards", WORD_BYTES), ("parts", PART_BYTES))}
    out, model = _scored(keyed, id_column, place, model, discount, folder is not None)
    if folder:
        mapped.write(f"{folder}/model", model, {})  # last: a folder without it is not a whole model
    else:
        remove(spark, place)
    return out


def score_by(folder: str, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The columns of ``score`` for any texts, by a model that ``score`` has kept in a folder; nothing is learnt."""
    model, _ = mapped.read(f"{folder}/model")
    keyed, size = _keyed(docs, F.lit(False), id_column, text_column)
    return _scored(keyed, id_column, folder, model | {"parts": 1 + size // PART_BYTES}, None)[0]
