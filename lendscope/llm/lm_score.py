"""LM scoring (operator 1): interpolated modified Kneser-Ney n-grams of any order from 2.

Counting runs in Spark. Map tasks hash the words of the training texts, count
their own n-grams and send them in packed blocks to shards; a shard is dealt by
the context (all words but the last) salted with 8 values of the last word, so
the successors of a very common context are spread. The number of shards follows
the size of the texts, so a shard stays of one size at any input. A shard adds up
its n-grams, writes them sorted, and passes on sums only (already added up, so a
common context is one row per shard): for a context its total and its n-grams seen
once, twice and more; for the n-grams one word shorter, without the first word,
the different words that stand before them. Those are the counts of the next
lower order, merged the same way, down to single words. A few global sums give
each order's discounts.

The model is a set of sorted hash arrays in the shared folder: by order and shard
the n-gram hashes with their counts and the context hashes with their sums, by
word shard the word hashes with their sums (which serve as contexts of bigrams).
Workers memory-map them and look up a whole batch at once.

P(w|c) = max(n(c,w) - D(n), 0) / n(c) + g(c) P(w|c without its first word)
P(w)   = max(N(w) - D'(N), 0) / N + g' / (V + 1)

with n the count in the highest order and the different words before the n-gram in
the lower ones, N(w) the different left neighbours of w, D and D' each order's
modified discounts for counts 1, 2 and 3 or more, and g what they take away. A
text is its words and one end; before it stand as many start marks as a context has
words. An unseen context passes the whole mass on; unknown words share g' / (V + 1).

Cases: null text counts as empty (one end); without training rows the
model is uniform over one word and every known count is 0; repeated rows are learned and scored each;
an empty table gives no rows; other columns are ignored; an order below 2 raises ValueError. All training
rows are counted, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lendscope.llm.common import batch, byte_texts, fold, mapped, put_file, scratch, shuffle_partitions
from lendscope.llm.words import NONSPACE, hash_words, mix

#: Words of an n-gram, where the caller names none
ORDER = 2

#: Words hash to 64 bits; these two stand for the marks around a text.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
SALTS = np.uint64(8)
#: A map task adds up its n-grams when it holds this many tokens.
FLUSH_TOKENS = 1_000_000
#: Bytes of training text for each shard
SHARD_BYTES = 32 << 20

#: Blocks by kind: 2 and more for the n-grams of that order, WORDS, CONTEXTS + order, SUMS + order (1: words)
WORDS, CONTEXTS, SUMS = 0, 1000, 2000
_BLOCK = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("block", pa.binary())])
_BLOCK_DDL = "kind int, shard int, block binary"


def _sequence(texts: list[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Every token with the order - 1 words before it, one array a place, and its
    text's number. A text ends in END and follows START marks."""
    h, offsets = hash_words(texts, NONSPACE)
    n = np.diff(offsets)
    ends = offsets[1:] + np.arange(len(n))
    word = np.full(len(h) + len(n), END, np.uint64)
    inner = np.ones(len(word), bool)
    inner[ends] = False
    word[inner] = h
    place = np.arange(len(word)) - np.repeat(ends - n, n + 1)
    places = [word]
    for back in range(1, order):
        places.append(np.where(place >= back, np.roll(word, back), START))
    return places[::-1], np.repeat(np.arange(len(n)), n + 1)


def _hashed(places: list[np.ndarray]) -> np.ndarray:
    h = places[0]
    for p in places[1:]:
        h = mix(h * np.uint64(3) + mix(p))
    return h


def _gram_shard(context: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    return (mix(context + mix(word) % SALTS * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(shards)).astype(np.int32)


def _key_shard(key: np.ndarray, shards: int) -> np.ndarray:
    return (mix(key ^ np.uint64(0xA5A5A5A5)) % np.uint64(shards)).astype(np.int32)


def _starts(places: list[np.ndarray]) -> np.ndarray:
    """Where a new value begins in sorted rows."""
    new = np.ones(len(places[0]), bool)
    if len(new):
        new[1:] = np.any([p[1:] != p[:-1] for p in places], axis=0)
    return np.flatnonzero(new)


def _added_up(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Equal keys as one row, sorted."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    first = _starts(keys)
    return [k[first] for k in keys], [np.add.reduceat(s[order], first) if len(first) else s[order] for s in sums]


def _narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as the largest needs (none for zeros)."""
    top = int(a.max(initial=0))
    return a.astype(np.min_scalar_type(top)) if top else a[:0]


def _packed(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """Rows, bytes of each column, columns."""
    narrow = [_narrow(a) for a in arrays]
    return [np.array([len(arrays[0]), *[a.itemsize if len(a) else 0 for a in narrow]], np.int64), *narrow]


def _unpacked(raw: np.ndarray, width: int) -> list[np.ndarray]:
    n, *sizes = raw[:8 * (width + 1)].view(np.int64).tolist()
    at, out = 8 * (width + 1), []
    for size in sizes:
        out.append(raw[at:at + n * size].view(f"u{size}") if size else np.zeros(n, np.uint8))
        at += n * size
    return out


def _blocks(kind: int, shard: np.ndarray, arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A packed block of the arrays' rows for each shard."""
    order = np.argsort(shard, kind="stable")
    shards, begin = np.unique(shard[order], return_index=True)
    for s, rows in zip(shards, np.split(order, begin[1:]), strict=True):
        block = b"".join(p.tobytes() for p in _packed([a[rows] for a in arrays]))
        yield batch(_BLOCK, [kind], [int(s)], [block])


def _joined(blocks: list[bytes], keys: int, sums: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The rows of all blocks, equal keys added up."""
    parts = [_unpacked(np.frombuffer(b, np.uint8), keys + sums) for b in blocks]
    columns = [np.concatenate([p[i] for p in parts]) for i in range(keys + sums)]
    return _added_up([c.astype(np.uint64) for c in columns[:keys]], [c.astype(np.int64) for c in columns[keys:]])


def _count_grams(order: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def flush():
            nonlocal held
            if held:
                places, (count,) = _added_up([np.concatenate(p) for p in zip(*parts, strict=True)],
                                             [np.ones(held, np.int64)])
                parts.clear()
                held = 0
                yield from _blocks(order, _gram_shard(_hashed(places[:-1]), places[-1], shards), [*places, count])

        for b in batches:
            for at in range(0, b.num_rows, 250):
                places, _ = _sequence(byte_texts(b.column(0).slice(at, 250)), order)
                parts.append(places)
                held += len(places[0])
                if held >= FLUSH_TOKENS:
                    yield from flush()
        yield from flush()
    return run


def _counts_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _sums(order: int, shard: int, values: list[int]) -> pa.RecordBatch:
    return batch(_BLOCK, [SUMS + order], [shard], [np.array(values, np.int64).tobytes()])


def _merge_grams(base: str, order: int, top: int, shard: int, blocks: list[bytes], shards: int):
    """Write a shard's n-grams; pass on their contexts' sums, the n-grams one word
    shorter with the different words before them, and the counts of the words."""
    places, (count,) = _joined(blocks, order, 1)
    h = _hashed(places)
    by_hash = np.argsort(h)
    h, c = h[by_hash], count[by_hash]
    many = c >= 255  # few: their counts stand apart, whole
    put_file(f"{base}/grams{order}/{shard}", [np.array([len(h), many.sum()], np.int64), h, h[many], c[many],
                                              np.where(many, 255, c).astype(np.uint8)])
    first = _starts(places[:-1])
    of_context = [np.add.reduceat(x.astype(np.int64), first) if len(first) else x.astype(np.int64)
                  for x in (count, count == 1, count == 2, count >= 3)]
    context = _hashed([p[first] for p in places[:-1]])
    one = np.ones(len(count), np.int64)
    zero = np.zeros(len(count), np.int64)
    words = []  # word, count, left neighbours, and the sums as a context
    if order == top:
        words.append([places[-1], count, one if order == 2 else zero, *[zero] * 4])
    elif order == 2:
        words.append([places[-1], zero, one, *[zero] * 4])
    if order == 2:
        words.append([context, *[zero[:len(first)]] * 2, *of_context])
    else:
        yield from _blocks(CONTEXTS + order, _key_shard(context, shards), [context, *of_context])
        shorter, (before,) = _added_up(places[1:], [one])
        yield from _blocks(order - 1, _gram_shard(_hashed(shorter[:-1]), shorter[-1], shards), [*shorter, before])
    if words:
        key, sums = _added_up([np.concatenate([w[0] for w in words])],
                              [np.concatenate([w[i] for w in words]) for i in range(1, 7)])
        yield from _blocks(WORDS, _key_shard(key[0], shards), [*key, *sums])
    yield _sums(order, shard, _counts_of_counts(count))


def _merge(base: str, top: int, shards: int, last: bool):
    """One step down: n-grams become sums and shorter n-grams, contexts are written,
    words are added up and written in the last step, global sums pass through."""
    def run(key, table):
        (kind, shard), blocks = [k.as_py() for k in key], table.column("block").to_pylist()
        if kind >= SUMS:
            out = [_sums(kind - SUMS, shard, np.sum([np.frombuffer(b, np.int64) for b in blocks], axis=0))]
        elif kind >= CONTEXTS:
            context, sums = _joined(blocks, 1, 4)
            put_file(f"{base}/contexts{kind - CONTEXTS}/{shard}", _packed([*context, *sums]))
            out = []
        elif kind == WORDS:
            word, sums = _joined(blocks, 1, 6)
            if last:
                put_file(f"{base}/words/{shard}", _packed([*word, *sums]))
                count, left = sums[0], sums[1]
                out = [_sums(1, shard, [*_counts_of_counts(left), count.sum(), (count > 0).sum(), left.sum()])]
            else:
                out = list(_blocks(WORDS, np.full(len(word[0]), shard, np.int32), [*word, *sums]))
        else:
            out = list(_merge_grams(base, kind, top, shard, blocks, shards))
        return pa.Table.from_batches(out, _BLOCK)
    return run


def _discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more."""
    if not n1 or not n2:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return [min(max(x, 0.01), k + 0.99) for k, x in enumerate(d)]


@dataclass
class Model:
    """What a task needs to map the files: folder, order, shards, and the global sums."""

    base: str
    order: int
    shards: int
    tokens: int
    distinct: int
    left: int
    #: by order, 1 for single words
    discounts: dict[int, list[float]]
    #: words with 1, 2 and 3 or more left neighbours
    left_counts: list[int]


def train(texts: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Count ``texts`` and write the model of ``order`` words to the shared folder."""
    if order < 2:
        raise ValueError(f"an n-gram model needs an order of 2 or more, not {order}")
    spark = texts.sparkSession
    base, text = scratch(spark, "lm"), F.col(text_col).cast("string")
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(shuffle_partitions(spark), -(-size // SHARD_BYTES))
    rows = texts.select(text).mapInArrow(_count_grams(order, shards), _BLOCK_DDL)
    for step in range(order, 0, -1):
        rows = rows.groupBy("kind", "shard").applyInArrow(_merge(base, order, shards, step == 1), _BLOCK_DDL)
    sums = {k: np.zeros(4 if k > 1 else 7, np.int64) for k in range(1, order + 1)}
    for r in rows.collect():  # a row a shard and order
        sums[r["kind"] - SUMS] += np.frombuffer(r["block"], np.int64)
    *left_counts, tokens, distinct, left = sums[1].tolist()
    return Model(base, order, shards, tokens, distinct, left,
                 {k: _discounts(*s[:4].tolist()) for k, s in sums.items()},
                 [*left_counts[:2], distinct - left_counts[0] - left_counts[1]])


class _Reader:
    """Memory-mapped arrays of a model, opened as shards are asked for."""

    def __init__(self, model: Model):
        self.m, self.open_ = model, {}

    def _file(self, kind: str, shard: int, width: int):
        if (kind, shard) not in self.open_:
            many = None
            try:
                raw = mapped(f"{self.m.base}/{kind}/{shard}")
            except FileNotFoundError:  # no row fell into this shard
                keys, values = np.zeros(0, np.uint64), []
            else:
                if kind.startswith("grams"):  # x counts of 255 or more stand apart
                    n, x = raw[:16].view(np.int64).tolist()
                    keys, rest = raw[16:16 + 8 * n].view(np.uint64), raw[16 + 8 * n:]
                    values = [rest[16 * x:]]
                    many = rest[:8 * x].view(np.uint64), rest[8 * x:16 * x].view(np.int64)
                else:
                    keys, *values = _unpacked(raw, width + 1)
            self.open_[kind, shard] = keys, values, many
        return self.open_[kind, shard]

    def lookup(self, kind: str, shard: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
        """The values of sorted ``key`` in its shards, 0 where it isn't there."""
        out = np.zeros((width, len(key)), np.int64)
        order = np.argsort(shard, kind="stable")  # keys stay sorted within a shard
        shards, begin = np.unique(shard[order], return_index=True)
        for s, rows in zip(shards, np.split(order, begin[1:]), strict=True):
            keys, values, many = self._file(kind, int(s), width)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key[rows]), len(keys) - 1)
                hit = keys[at] == key[rows]
                for i, v in enumerate(values):
                    out[i, rows[hit]] = v[at[hit]]
                if many is not None and len(many[0]):
                    big = rows[hit][out[0, rows[hit]] == 255]
                    out[0, big] = many[1][np.searchsorted(many[0], key[big])]
        return out

    def _counts(self, places: list[np.ndarray]) -> np.ndarray:
        """Count of every n-gram."""
        key, one, back = np.unique(_hashed(places), return_index=True, return_inverse=True)
        shard = _gram_shard(_hashed([p[one] for p in places[:-1]]), places[-1][one], self.m.shards)
        return self.lookup(f"grams{len(places)}", shard, key, 1)[0][back]

    def _contexts(self, places: list[np.ndarray]) -> np.ndarray:
        """Total of every context and its n-grams seen once, twice and more."""
        key, back = np.unique(_hashed(places), return_inverse=True)
        return self.lookup(f"contexts{len(places) + 1}", _key_shard(key, self.m.shards), key, 4)[:, back]

    def score(self, texts: list[bytes]):
        """Per text: tokens, known tokens, base log10 and model log10."""
        m, n_texts = self.m, len(texts)
        places, text = _sequence(texts, m.order)
        word, left = places[-1], places[-2]
        vocab, at = np.unique(np.concatenate([word, left]), return_inverse=True)
        stats = self.lookup("words", _key_shard(vocab, m.shards), vocab, 6)
        at_word, at_left = at[:len(word)], at[len(word):]
        count = stats[0][at_word]
        base = np.log10((count + 1) / (m.tokens + m.distinct + 1))
        d = np.array([0.0, *m.discounts[1]])
        nl = stats[1]
        floor = float(np.dot(d[1:], m.left_counts)) / m.left if m.left else 1.0
        single = (np.maximum(nl - d[np.minimum(nl, 3)], 0) / m.left if m.left else np.zeros(len(nl))) \
            + floor / (m.distinct + 1)
        p = single[at_word]
        for k in range(2, m.order + 1):
            d = np.array([0.0, *m.discounts[k]])
            total, *seen = stats[2:, at_left] if k == 2 else self._contexts(places[-k:-1])
            c = self._counts(places[-k:])
            with np.errstate(divide="ignore", invalid="ignore"):
                gamma = np.where(total > 0, (d[1] * seen[0] + d[2] * seen[1] + d[3] * seen[2]) / total, 1.0)
                direct = np.where(total > 0, np.maximum(c - d[np.minimum(c, 3)], 0) / total, 0.0)
            p = direct + gamma * p
        return [np.bincount(text, minlength=n_texts), np.bincount(text[count > 0], minlength=n_texts),
                np.bincount(text, base, n_texts), np.bincount(text, np.log10(p), n_texts)]


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                     ("score", pa.float64()), ("perplexity", pa.float64())])


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                n, known, base, score = reader.score(byte_texts(part.column(2)))
                yield batch(_SCORES, part.column(0), part.column(1), n, known, np.full(len(n), model.tokens), base,
                            score, 10.0 ** np.minimum(-score / n, 300))
    return run


def score_texts(docs: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    return (docs.select(F.col(id_col).cast("long"), held_out, F.col(text_col).cast("string"))
            .mapInArrow(_score(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                       "base_score double, score double, perplexity double"))


def lm_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The registered query: learn from crc32(doc_id) mod 7 != 2, score all."""
    held = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    return score_texts(docs, train(docs.where(~held), order=order), held)
