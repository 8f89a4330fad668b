"""Language-model scores from a sharded Elias-Fano bigram trie.

The model is interpolated absolute discounting: the probability of a word after
another is its discounted share among the other's successors, plus what the
discount left over times the word's own (discounted) share of all words. All
unseen words together are one class that has the rest.

Texts become batches of word numbers, each with its own small vocabulary,
written once. A batch asks each shard for what it needs of the words and of the
pairs of words whose first word the shard owns (by ranges of the hash), with
its own training counts. So a word or pair that fills a third of the corpus is
one entry of a batch, however often it occurs. A shard adds the counts up,
builds its part of the trie, looks every asked pair up, and answers. Pairs that
begin with a very frequent word are dealt by their second word instead.

The trie's levels lie in one compact buffer that is read in place: words and
their counts; pointers to their successors, which are monotone, and the
successors themselves, made monotone by adding up from word to word, in
Elias-Fano form; and one byte per pair for its probability, an entry of a
codebook of equally filled bins. A pair is looked up between its word's
pointers, by a successor search relative to the word.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from mercaflow.llm.memory import give_back, giving_back
from mercaflow.llm.storage import partitions, stored
from mercaflow.llm.words import LOWER, U64, words_of

BATCH_WORDS = 750_000
SHARD_WORDS = 2_500_000
# Words with more than this part of a shard's share are dealt by their successor.
HOT_SHARE = 0.25
CODES = 256
# Stands for the end of a text, and for what precedes its first word.
END = U64(0x5851F42D4C957F2D)

BATCH_SCHEMA = (
    "batch long, doc_ids array<long>, ends binary, training binary, vocabulary binary, counts binary, numbers binary"
)
ASK_SCHEMA = "batch long, shard long, words binary, word_counts binary, contexts binary, fans binary, successors binary, pair_counts binary"
ANSWER_SCHEMA = "batch long, shard long, distinct_words long, tokens long, once long, twice long, word_counts binary, context_counts binary, left_over binary, codes binary, codebook binary, hot_left binary"


# ---- Elias-Fano -------------------------------------------------------------


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of each value, one after the other."""
    if not bits or not len(values):
        return np.zeros(0, dtype=np.uint8)
    step, places = 1 << 16, np.arange(bits)  # a multiple of 8 values fills whole bytes
    parts = []
    for first in range(0, len(values), step):
        planes = (values[first : first + step, None] >> places) & 1
        parts.append(np.packbits(planes.astype(np.uint8).ravel(), bitorder="little"))
    return np.concatenate(parts)


def _unpacked(packed: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
    value = np.zeros(len(at), dtype=np.int64)
    for bit in range(bits):
        place = at * bits + bit
        value |= ((packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(np.int64) << bit
    return value


@dataclass
class EliasFano:
    """A monotone sequence: low bits as they are, high parts in unary."""

    count: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    _ones: np.ndarray | None = None

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        count, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(1, count)).bit_length() - 1)
        unary = np.zeros((top >> bits) + count + 1, dtype=np.uint8)
        unary[(values >> bits) + np.arange(count)] = 1
        return EliasFano(count, bits, _packed(values, bits), np.packbits(unary, bitorder="little"))

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        if self._ones is None:
            self._ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little")).astype(np.int32)
        return ((self._ones[at].astype(np.int64) - at) << self.bits) | _unpacked(self.low, at, self.bits)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.count, self.bits], dtype="<i8"), self.low, self.high]


def _levels(parts: list[np.ndarray]) -> bytes:
    """Arrays one after the other, behind their lengths, each at a multiple of 8."""
    head = np.array([len(parts), *(p.nbytes for p in parts)], dtype="<i8").tobytes()
    return head + b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)


def _views(buffer: bytes | memoryview) -> list[np.ndarray]:
    count = int(np.frombuffer(buffer, dtype="<i8", count=1)[0])
    sizes = np.frombuffer(buffer, dtype="<i8", count=count, offset=8)
    at, views = 8 * (count + 1), []
    for size in map(int, sizes):
        views.append(np.frombuffer(buffer, dtype=np.uint8, count=size, offset=at))
        at += size + -size % 8
    return views


# ---- the trie of a shard ----------------------------------------------------


@dataclass
class Trie:
    words: np.ndarray  # sorted hashes of all words of the shard's pairs, and of its own
    counts: np.ndarray  # training counts of the words that the shard owns
    contexts: np.ndarray  # numbers of the words that have successors
    totals: np.ndarray  # for each context: how often it is one, and what discounts leave over
    left_over: np.ndarray
    pointers: EliasFano
    successors: EliasFano
    codes: np.ndarray
    codebook: np.ndarray

    def buffer(self) -> bytes:
        return _levels(
            [self.words, self.counts, self.contexts, self.totals, self.left_over, self.codes, self.codebook]
            + self.pointers.parts()
            + self.successors.parts()
        )

    @staticmethod
    def read(buffer: bytes) -> Trie:
        v = _views(buffer)
        pointers, successors = (
            EliasFano(*map(int, v[i].view("<i8")), v[i + 1], v[i + 2]) for i in (7, 10)
        )
        return Trie(
            v[0].view("<u8"), v[1].view("<i8"), v[2].view("<i8"), v[3].view("<i8"), v[4].view("<f8"),
            pointers, successors, v[5], v[6].view("<f4"),
        )

    def context(self, word: np.ndarray) -> np.ndarray:
        """The place of each word among the contexts, -1 if it is none."""
        at = np.minimum(np.searchsorted(self.contexts, word), max(0, len(self.contexts) - 1))
        return np.where(self.contexts[at] == word, at, -1) if len(self.contexts) else np.full(len(word), -1)

    def code(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The code of each pair, -1 where the trie doesn't have it. Successor
        numbers of a context are stored on top of the context's place times
        the number of words."""
        found = np.full(len(context), -1, dtype=np.int64)
        todo = np.flatnonzero(context >= 0)
        low, end = self.pointers[context[todo]], self.pointers[context[todo] + 1]
        high, wanted = end.copy(), context[todo] * len(self.words) + successor[todo]
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            less = self.successors[middle] < wanted[active]
            low[active[less]] = middle[less] + 1
            high[active[~less]] = middle[~less]
            active = active[low[active] < high[active]]
        inside = np.flatnonzero(low < end)
        hit = inside[self.successors[low[inside]] == wanted[inside]]
        found[todo[hit]] = self.codes[low[hit]]
        return found


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once else 0.5


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte for each value and the codebook: the means of bins, half of
    which hold equally many values, and half equally many different ones."""
    distinct = np.unique(values)
    if len(distinct) <= CODES:
        edges = (distinct[1:] + distinct[:-1]) / 2
    else:
        cuts = np.linspace(0, 1, CODES // 2 + 1)[1:-1]
        edges = np.unique(np.concatenate([np.quantile(values, cuts), np.quantile(distinct, cuts)]))
    codes = np.searchsorted(edges, values)
    sums = np.bincount(codes, weights=values, minlength=CODES)
    return codes.astype(np.uint8), (sums / np.maximum(1, np.bincount(codes, minlength=CODES))).astype("<f4")


def build_trie(words, owned_counts, contexts, successors, counts, hot: dict[int, int]) -> Trie:
    """From sorted word hashes, the training counts of those owned, and the
    distinct pairs (word numbers, sorted) with their training counts. ``hot``
    has the context counts of words whose pairs lie in several shards."""
    seen = counts > 0
    if not seen.all():
        contexts, successors, counts = contexts[seen], successors[seen], counts[seen]
    del seen
    discount = _discount(counts)
    fresh = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(contexts) else contexts
    own, fan = contexts[fresh], np.diff(np.append(fresh, len(contexts)))
    totals = np.add.reduceat(counts, fresh) if len(fresh) else np.zeros(0, dtype=np.int64)
    for word, total in hot.items():
        at = np.searchsorted(words, U64(word))
        place = np.searchsorted(own, at)
        if at < len(words) and words[at] == U64(word) and place < len(own) and own[place] == at:
            totals[place] = total
    place = np.repeat(np.arange(len(own)), fan)
    values = counts - discount
    values /= totals[place]
    codes, codebook = _quantised(np.log10(values, out=values))
    del values
    return Trie(
        words.astype("<u8"), owned_counts.astype("<i8"), own.astype("<i8"), totals.astype("<i8"),
        (discount * fan / totals).astype("<f8"), EliasFano.of(np.concatenate([[0], np.cumsum(fan)])),
        EliasFano.of(place * len(words) + successors), codes, codebook,
    )


# ---- batches ----------------------------------------------------------------


def _batching(batch_words: int):
    """Joins the texts of a task to batches, with numbered words."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for words in words_of(batch.column("text"), LOWER):
                part = batch.slice(words.first, words.last - words.first)
                training = np.array(part.column("training").to_pylist(), dtype=bool)
                held.append((part.column("doc_id").to_pylist(), training, words.hashes, np.diff(words.bounds)))
                size += len(words.hashes)
                if size >= batch_words:
                    yield _batch((task << 32) + made, held)
                    made, held, size = made + 1, [], 0
        if held:
            yield _batch((task << 32) + made, held)

    return join


def _batch(number: int, held: list) -> pa.RecordBatch:
    ids = [i for h in held for i in h[0]]
    training = np.concatenate([h[1] for h in held])
    sizes = np.concatenate([h[3] for h in held])
    hashes = np.empty(int(sizes.sum()) + len(sizes), dtype=U64)
    ends = np.cumsum(sizes + 1)
    is_word = np.ones(len(hashes), dtype=bool)
    is_word[ends - 1] = False
    hashes[is_word] = np.concatenate([h[2] for h in held])
    hashes[ends - 1] = END
    vocabulary, inverse = np.unique(hashes, return_inverse=True)
    counts = np.bincount(inverse, weights=np.repeat(training, sizes + 1), minlength=len(vocabulary))
    # Numbers by frequency, and their bytes apart: the higher ones are mostly zero.
    order = np.argsort(-np.bincount(inverse, minlength=len(vocabulary)), kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    numbers = rank[inverse].astype("<u4")
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]),
            pa.array([ids], type=pa.list_(pa.int64())),
            pa.array([ends.astype("<i8").tobytes()]),
            pa.array([training.tobytes()]),
            pa.array([vocabulary.astype("<u8").tobytes()]),
            pa.array([counts.astype("<u4").tobytes()]),
            pa.array([numbers.view(np.uint8).reshape(-1, 4).T.tobytes() + order.astype("<u4").tobytes()]),
        ],
        [c.split()[0] for c in BATCH_SCHEMA.replace("array<long>", "array").split(", ")],
    )


@dataclass
class _Pairs:
    """The distinct pairs of a batch in the order in which shards are asked."""

    numbers: np.ndarray  # of each token, in the vocabulary
    contexts: np.ndarray
    successors: np.ndarray
    counts: np.ndarray
    pair_of: np.ndarray  # of each token, with the one before it
    shard_bounds: np.ndarray
    word_bounds: np.ndarray


def _pairs(row, shards: int, hot: np.ndarray) -> _Pairs:
    ends = np.frombuffer(row.ends, dtype="<i8")
    training = np.frombuffer(row.training, dtype=bool)
    vocabulary = np.frombuffer(row.vocabulary, dtype="<u8")
    count = int(ends[-1])
    numbers = np.frombuffer(row.numbers, dtype=np.uint8)
    ranks = np.ascontiguousarray(numbers[: 4 * count].reshape(4, -1).T).view("<u4").ravel()
    numbers = numbers[4 * count :].view("<u4")[ranks].astype(np.int64)
    end = np.searchsorted(vocabulary, END)
    before = np.concatenate([[end], numbers[:-1]])
    key, inverse = np.unique(before * len(vocabulary) + numbers, return_inverse=True)
    inverse = inverse.astype(np.int32)
    del before, ranks
    sizes = np.diff(np.concatenate([[0], ends]))
    counts = np.bincount(inverse, weights=np.repeat(training, sizes), minlength=len(key)).astype(np.int64)
    context, successor = key // len(vocabulary), key % len(vocabulary)
    borders = np.arange(shards + 1, dtype=np.float64) / shards * 2.0**64
    word_bounds = np.searchsorted(vocabulary.astype(np.float64), borders[1:-1])
    word_bounds = np.concatenate([[0], word_bounds, [len(vocabulary)]])
    owner = np.repeat(np.arange(shards), np.diff(word_bounds))
    is_hot = np.isin(vocabulary, hot)
    shard = np.where(is_hot[context], owner[successor], owner[context])
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    return _Pairs(numbers, context[order], successor[order], counts[order], place[inverse], bounds, word_bounds)


def _asking(shards: int, hot: np.ndarray):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches:
            for row in (r for i in range(len(frame)) for r in frame.slice(i, 1).to_pandas().itertuples()):
                vocabulary, counts = np.frombuffer(row.vocabulary, dtype="<u8"), np.frombuffer(row.counts, dtype="<u4")
                pairs = _pairs(row, shards, hot)
                for shard in range(shards):
                    first, last = pairs.word_bounds[shard : shard + 2]
                    a, b = pairs.shard_bounds[shard : shard + 2]
                    if first == last and a == b:
                        continue
                    context, successor = pairs.contexts[a:b], pairs.successors[a:b]
                    # Words of the request: those owned, then others that its pairs have.
                    used = np.zeros(len(vocabulary), dtype=bool)
                    used[context], used[successor], used[first:last] = True, True, False
                    other = np.flatnonzero(used)
                    local = np.empty(len(vocabulary), dtype=np.int64)
                    local[first:last] = np.arange(last - first)
                    local[other] = np.arange(len(other)) + (last - first)
                    fresh = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if b > a else np.zeros(0, dtype=np.int64)
                    words = np.concatenate([vocabulary[first:last], vocabulary[other]])
                    columns = [
                        words.astype("<u8"), counts[first:last], local[context[fresh]].astype("<u4"),
                        np.diff(np.append(fresh, b - a)).astype("<u4"), local[successor].astype("<u4"), pairs.counts[a:b].astype("<u4"),
                    ]
                    arrays = [pa.array([row.batch]), pa.array([shard]), pa.array([columns[0].tobytes()])]
                    arrays += [pa.array([_shuffled(c)]) for c in columns[1:]]
                    yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in ASK_SCHEMA.split(", ")])
                del pairs, local, used
                give_back()

    return ask


def _shuffled(values: np.ndarray) -> bytes:
    """32-bit values with their bytes apart, which compresses."""
    return np.ascontiguousarray(values.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def _sorted_back(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _answering(hot: dict[int, int]):
    hot_words = np.array(sorted(hot), dtype=U64)

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("batch")
        word_lists = [np.frombuffer(w, dtype="<u8") for w in frame["words"]]
        owned = [_sorted_back(c) for c in frame["word_counts"]]
        starts = np.concatenate([[0], np.cumsum([len(w) for w in word_lists])])
        words, inverse = np.unique(np.concatenate(word_lists), return_inverse=True)
        inverse = inverse.astype(np.uint32)
        counts, is_owned = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=bool)
        asked, keys, train = [], [], []
        for i, own in enumerate(owned):
            local = inverse[starts[i] : starts[i + 1]]
            counts[local[: len(own)]] += own
            is_owned[local[: len(own)]] = True
            context = np.repeat(local[_sorted_back(frame["contexts"].iloc[i])], _sorted_back(frame["fans"].iloc[i]))
            asked.append((context, local[_sorted_back(frame["successors"].iloc[i])]))
            often = _sorted_back(frame["pair_counts"].iloc[i])
            seen = often > 0
            keys.append(context[seen].astype(np.int64) * len(words) + asked[i][1][seen])
            train.append(often[seen])
        key, total = _summed(np.concatenate(keys), np.concatenate(train))
        del keys, train
        size = max(1, len(words))
        context, successor = (key // size).astype(np.int32), (key % size).astype(np.int32)
        del key
        built = build_trie(words, np.where(is_owned, counts, 0), context, successor, total, hot).buffer()
        del words, counts, is_owned, context, successor, total
        trie = Trie.read(built)
        numbers = [int(x.sum()) for x in (trie.counts > 0, trie.counts, trie.counts == 1, trie.counts == 2)]
        # Of all its pairs, whatever a batch asks; with one of the answers only.
        number = np.minimum(np.searchsorted(trie.words, hot_words), len(trie.words) - 1)
        at = np.where(trie.words[number] == hot_words, trie.context(number), -1)
        hot_left = np.where(at >= 0, trie.left_over[at], 0.0) if len(trie.contexts) else np.zeros(len(hot_words))
        rows = []
        for i, own in enumerate(owned):
            context, successor = asked[i]
            fresh = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else context
            at = trie.context(context[fresh])
            known = at >= 0
            codes = trie.code(np.repeat(at, np.diff(np.append(fresh, len(context)))), successor)
            rows.append(
                (
                    frame["batch"].iloc[i],
                    frame["shard"].iloc[i],
                    *numbers,
                    _shuffled(trie.counts[inverse[starts[i] : starts[i] + len(own)]].view("<u4").reshape(-1, 2)[:, 0])
                    + _shuffled(trie.counts[inverse[starts[i] : starts[i] + len(own)]].view("<u4").reshape(-1, 2)[:, 1]),
                    np.where(known, trie.totals[at] if len(trie.totals) else 0, 0).astype("<i8").tobytes(),
                    np.where(known, trie.left_over[at] if len(trie.totals) else 0, 0).astype("<f4").tobytes(),
                    # Pairs without an entry are marked in a bitmap in front of the codes.
                    np.packbits(codes >= 0).tobytes() + np.maximum(codes, 0).astype(np.uint8).tobytes(),
                    trie.codebook.tobytes(),
                    None if i else hot_left.astype("<f8").tobytes(),
                )
            )
        del trie, built, asked, inverse, owned, word_lists
        give_back()
        return pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER_SCHEMA.split(", ")])

    return answer


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    fresh = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    total = np.add.reduceat(counts, fresh, dtype=np.int64) if len(fresh) else np.zeros(0, dtype=np.int64)
    return keys[fresh], total


def _scoring(shards: int, hot: np.ndarray, hot_left: np.ndarray, tokens: int, distinct: int, once_discount: float):
    """Scores of the documents of a batch from the answers to it. What discounts
    leave of the words ``hot`` is ``hot_left``, from all shards."""

    def score(batch: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        give_back()
        for row in batch.itertuples():
            vocabulary = np.frombuffer(row.vocabulary, dtype="<u8")
            pairs = _pairs(row, shards, hot)
            counts = np.zeros(len(vocabulary), dtype=np.int64)
            left = np.ones(len(vocabulary))
            share = np.zeros(len(pairs.contexts))
            for x in answers.itertuples():
                first, last = pairs.word_bounds[x.shard : x.shard + 2]
                a, b = pairs.shard_bounds[x.shard : x.shard + 2]
                half = len(x.word_counts) // 2
                counts[first:last] = _sorted_back(x.word_counts[:half]) + (_sorted_back(x.word_counts[half:]).astype(np.int64) << 32)
                context = pairs.contexts[a:b]
                own = context[np.concatenate([[True], context[1:] != context[:-1]])] if b > a else context
                total, over = np.frombuffer(x.context_counts, dtype="<i8"), np.frombuffer(x.left_over, dtype="<f4")
                left[own[total > 0]] = over[total > 0]
                bitmap = -(-(b - a) // 8)
                data = np.frombuffer(x.codes, dtype=np.uint8)
                has = np.unpackbits(data[:bitmap])[: b - a].astype(bool)
                share[a:b] = np.where(has, 10.0 ** np.frombuffer(x.codebook, dtype="<f4")[data[bitmap:]].astype(np.float64), 0.0)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, vocabulary), len(hot) - 1)
                left = np.where(hot[at] == vocabulary, hot_left[at], left)
            unknown = max(once_discount * distinct, 0.5) / max(1, tokens)
            single = np.where(counts > 0, (counts - once_discount) / max(1, tokens), unknown)
            pair_score = np.log10(share + left[pairs.contexts] * single[pairs.successors])
            base = np.log10((counts + 1) / (tokens + distinct + 1))
            ends = np.frombuffer(row.ends, dtype="<i8")
            starts = np.concatenate([[0], ends[:-1]])
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.Series(list(row.doc_ids), dtype="Int64"),
                        "held_out": ~np.frombuffer(row.training, dtype=bool),
                        "n_tokens": ends - starts,
                        "n_known": np.add.reduceat((counts > 0)[pairs.numbers].astype(np.int64), starts),
                        "train_tokens": tokens,
                        "base_score": np.add.reduceat(base[pairs.numbers], starts),
                        "score": np.add.reduceat(pair_score[pairs.pair_of], starts),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame([], columns=[c.split()[0] for c in SCORE_SCHEMA.split(", ")])

    return score


SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _hot_left(answers: DataFrame, count: int) -> np.ndarray:
    """What discounts leave over of each of the ``count`` hot words: the sum over
    all shards that hold pairs of it."""

    def shares(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for data in frame.column("hot_left").to_pylist():
                share = np.frombuffer(data, dtype="<f8")
                place = np.flatnonzero(share)
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(share[place])], ["place", "share"])

    each = answers.filter("hot_left is not null").select("hot_left").mapInArrow(shares, "place long, share double")
    left = np.zeros(count)
    for row in each.groupBy("place").agg(F.sum("share").alias("share")).toLocalIterator():
        left[row["place"]] = row["share"]
    return left


def _hot_words(batches: DataFrame, least: float) -> dict[int, int]:
    """Counts of the words that make up ``least`` of the training tokens or
    more, which are few; only words that do so in some batch are looked at, as
    the others do not in all."""

    def candidates(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for words, counts in zip(frame.column("vocabulary").to_pylist(), frame.column("counts").to_pylist()):
                counts = np.frombuffer(counts, dtype="<u4")
                often = np.frombuffer(words, dtype="<i8")[counts >= max(1, least * counts.sum())]
                yield pa.RecordBatch.from_arrays([pa.array(often)], ["word"])

    names = batches.select("vocabulary", "counts").mapInArrow(candidates, "word long").distinct()
    chosen = np.array(sorted(np.array([r["word"] for r in names.toLocalIterator()], dtype=np.int64).view(U64)), dtype=U64)

    def totals(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for words, counts in zip(frame.column("vocabulary").to_pylist(), frame.column("counts").to_pylist()):
                words = np.frombuffer(words, dtype="<u8")
                at = np.flatnonzero(np.isin(words, chosen))
                values = np.frombuffer(counts, dtype="<u4")[at].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words[at].view("<i8")), pa.array(values)], ["word", "n"])
                everything = np.frombuffer(counts, dtype="<u4").sum(dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([None], type=pa.int64()), pa.array([everything])], ["word", "n"])

    sums = batches.select("vocabulary", "counts").mapInArrow(totals, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = {r["word"]: r["n"] for r in sums.toLocalIterator()}
    enough = max(1, least * total.pop(None, 0))
    return {word % (1 << 64): n for word, n in total.items() if n >= enough}


def score_corpus(
    docs: DataFrame, training: Column, batch_words: int = BATCH_WORDS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` for each row of ``docs`` (``doc_id``, ``text``).

    Rows for which ``training`` is true teach the model; null counts as false.
    A null or empty text is its end alone. ``base_score`` is the add-one
    unigram score, ``score`` the model's; both are log10 probabilities of all
    tokens, the end included. Repeated rows are counted and scored each. With
    no training rows every word is unknown. Other columns are not looked at.
    """
    spark = docs.sparkSession
    flagged = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training"))
    made = flagged.mapInArrow(giving_back(_batching(batch_words)), BATCH_SCHEMA)
    # Bucketed by batch, so that the last step reads batches where their answers arrive.
    name = f"lm_batches_{uuid.uuid4().hex}"
    made.write.format("parquet").bucketBy(partitions(spark), "batch").saveAsTable(name)
    batches = spark.table(name)
    sizes = batches.select(F.octet_length("numbers").alias("bytes"), F.octet_length("vocabulary").alias("words"))
    words = sizes.agg(F.sum((F.col("bytes") - F.col("words") / 2) / 4)).first()[0] or 0
    shards = max(1, round(words / shard_words))
    hot = _hot_words(batches, HOT_SHARE / shards)
    hot_words = np.array(sorted(hot), dtype=U64)
    asked = batches.drop("doc_ids").mapInArrow(giving_back(_asking(shards, hot_words)), ASK_SCHEMA)
    answers = stored(asked.groupBy("shard").applyInPandas(_answering(hot), ANSWER_SCHEMA), "answers")
    names = ("distinct_words", "tokens", "once", "twice")
    each = answers.groupBy("shard").agg(*(F.max(n).alias(n) for n in names))
    distinct, tokens, once, twice = (x or 0 for x in each.agg(*(F.sum(n) for n in names)).first())
    discount = once / (once + 2 * twice) if once else 0.5
    scoring = _scoring(shards, hot_words, _hot_left(answers, len(hot_words)), tokens, distinct, discount)
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(scoring, SCORE_SCHEMA)

