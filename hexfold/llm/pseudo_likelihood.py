"""LM scoring by masked pseudo-likelihood: each word predicted from both sides.

Words are counted over all documents.  The ``CLASSES * CLASSES`` commonest,
less one class of hash buckets for the rest, are what the network names; each
other word has its bucket's probability times its share of the bucket's counts,
which are a written table: the commonest ``HELD`` are broadcast to the scoring
tasks, it is joined for all others.  One count of every bucket is
kept for words that no document has.  A network in numpy sums position-specific embeddings of the two words to the left and the
two to the right, takes tanh, and predicts the masked word's class and then
the word in its class.  A document's score is the sum of the conditional log
probabilities of all its words, and their mean.

Training sees every document: each input partition trains from the current
network on every ``ROUNDS``-th word of its texts, from the round's number on,
so that every word is a target once in all rounds, and the partitions'
networks are averaged by their word counts, in groups of ``FAN`` at a time, so
that neither a task nor the driver holds more than that many.  What is
gathered grows with the input: counts of all words and one network a partition.

Null and empty texts have no words, sum 0 and mean 0; repeated rows get equal
scores; without any words the network is untrained; no rows give no rows; a kept
column with a made one's name becomes ``<name>_in``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import LOWER, held, passes, prefix_hash, signed, span_hash, word_spans, written

CLASSES = 64
WORDS = CLASSES * CLASSES  # the last class is hash buckets
PAD = WORDS
SIZE = 24
SIDES = (-2, -1, 1, 2)
ROUNDS = 2
BATCH = 8192
RATE = 0.15
BLOCK = 1 << 14
FAN = 32
CHUNK = 1 << 15
PART = 1 << 11  #: rows of one product, whose logits stay in cache
LIMIT = np.float32(60)  #: of a logit, so that no exponential overflows
ONES = np.ones(CLASSES, np.float32)
HELD = 1 << 19  #: words whose shares are broadcast (16 bytes each); rarer ones are joined
UNIT = 1 << 32  #: of log shares, summed as whole numbers so that no order matters


def shapes() -> list[tuple[int, ...]]:
    return [(len(SIDES), WORDS + 1, SIZE), (SIZE + 1, CLASSES), (CLASSES, SIZE + 1, CLASSES)]


class Network:
    """Embeddings by side, class weights, word weights by class; the last row of weights are biases."""

    def __init__(self, flat: np.ndarray | None = None):
        sizes = [int(np.prod(s)) for s in shapes()]
        if flat is None:
            rng = np.random.default_rng(17)
            flat = np.concatenate([rng.normal(0, 0.1, n) for n in sizes]).astype(np.float32)
            for weights in np.split(flat, np.cumsum(sizes)[:-1])[1:]:
                weights.reshape(-1, SIZE + 1, CLASSES)[:, SIZE] = 0
        self.flat = flat
        parts = np.split(flat, np.cumsum(sizes)[:-1])
        self.embed, self.top, self.low = (p.reshape(s) for p, s in zip(parts, shapes(), strict=True))


def hidden_layer(net: Network, context: np.ndarray) -> np.ndarray:
    """tanh of the summed embeddings, and a one for the biases."""
    out = np.ones((len(context), SIZE + 1), np.float32)
    np.tanh(sum(net.embed[k][context[:, k]] for k in range(len(SIDES))), out=out[:, :SIZE])
    return out


def classes_of(word: np.ndarray):
    """The class and the slice of every class that occurs, of words sorted by class."""
    bounds = np.searchsorted(word, np.arange(CLASSES + 1) * CLASSES).tolist()
    return [(c, slice(a, b)) for c, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if a < b]


def log_probabilities(net: Network, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Of each word given its context (words by side)."""
    order = np.argsort((word // CLASSES).astype(np.uint8), kind="stable")
    context, word = context[order], word[order]
    hidden, kind, place = hidden_layer(net, context), word // CLASSES, word % CLASSES
    value = np.empty(len(word), np.float32)
    for at in range(0, len(word), PART):
        part = slice(at, at + PART)
        logit = hidden[part] @ net.top
        value[part] = logit[np.arange(len(logit)), kind[part]] - log_sums(logit)
    for c, part in classes_of(kind * CLASSES):
        logit = hidden[part] @ net.low[c]
        value[part] += logit[np.arange(len(logit)), place[part]] - log_sums(logit)
    out = np.empty_like(value)
    out[order] = value
    return out


def log_sums(logit: np.ndarray) -> np.ndarray:
    """Logarithms of the rows' sums of exponentials, over the logits."""
    np.exp(np.minimum(logit, LIMIT, out=logit), out=logit)
    return np.log(logit @ ONES)


def move(value: np.ndarray, square: np.ndarray, gradient: np.ndarray) -> None:
    """An Adagrad step, in place."""
    square += gradient * gradient
    value -= RATE * gradient / np.sqrt(square + 1e-6)


def errors(logit: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Softmax less one at the right places, over the logits."""
    np.exp(np.minimum(logit, LIMIT, out=logit), out=logit)
    logit *= (1 / (logit @ ONES))[:, None]
    logit[np.arange(len(right)), right] -= 1
    return logit


def step(net: Network, squares: Network, context: np.ndarray, word: np.ndarray) -> None:
    """One Adagrad step on the mean negative log probability."""
    order = np.argsort((word // CLASSES).astype(np.uint8), kind="stable")
    context, word = context[order], word[order]
    n, hidden, kind, place = len(word), hidden_layer(net, context), word // CLASSES, word % CLASSES
    back, top, low = np.empty((n, SIZE), np.float32), np.zeros_like(net.top), np.zeros_like(net.low)
    for at in range(0, n, PART):
        part = slice(at, at + PART)
        error = errors(hidden[part] @ net.top, kind[part])
        np.matmul(error, net.top[:SIZE].T, out=back[part])
        top += hidden[part].T @ error
    for c, part in classes_of(kind * CLASSES):
        error = errors(hidden[part] @ net.low[c], place[part])
        back[part] += error @ net.low[c, :SIZE].T
        np.matmul(hidden[part].T, error, out=low[c])
    move(net.top, squares.top, top / n)
    move(net.low, squares.low, low / n)
    hidden = hidden[:, :SIZE]
    back *= (1 - hidden * hidden) / n
    for k in range(len(SIDES)):
        order = np.argsort(context[:, k].astype(np.uint16), kind="stable")  # by radix
        at = context[order, k]
        head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        used = at[head]
        gradient = np.add.reduceat(back[order], head, axis=0)
        squares.embed[k][used] += gradient * gradient
        net.embed[k][used] -= RATE * gradient / np.sqrt(squares.embed[k][used] + 1e-6)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(data, offsets)
    return signed(span_hash(prefix_hash(LOWER[data]), starts, ends)), first


def numbers(known: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Vocabulary numbers of hashed words; others fall into the buckets of the last class."""
    keys, values = known[:2]
    out = WORDS - CLASSES + (hashes.view(np.uint64) >> np.uint64(58)).astype(np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        out = np.where(keys[at] == hashes, values[at], out)
    return out


def contexts(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words at both sides of each, padded at the ends of texts."""
    gap = len(SIDES) // 2
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(word)) + gap * (text + 1)
    wide = np.full(len(word) + gap * len(first), PAD)
    wide[place] = word
    return np.stack([wide[place + s] for s in SIDES], axis=1)


def vocabulary(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray, DataFrame, list[int]]:
    """Sorted hashes of the commonest words and their numbers by rank; counts of all words; counts of each bucket."""

    def count(batches):
        for batch, data, offsets in passes(batches, "_text", 1 << 22):
            words, counts = np.unique(word_hashes(data, offsets)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts.astype(np.int64))], names=["w", "n"])

    counts = written(docs.select(F.col(text).alias("_text")).mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "words")
    top = commonest(counts, WORDS - CLASSES)
    keys = np.array([r.w for r in top], np.int64)
    order = np.argsort(keys)
    totals = [0] * CLASSES
    for r in counts.groupBy(bucket("w").alias("b")).agg(F.sum("n").alias("n")).collect():
        totals[r.b] = r.n
    for r in top:
        totals[(r.w & (1 << 64) - 1) >> 58] -= r.n
    return keys[order], order, counts, totals


def level() -> F.Column:
    """A fine logarithm of n."""
    return F.floor(F.log2("n") * 64)


def levels(counts: DataFrame) -> list[tuple[int, int]]:
    """(level, words) of a histogram of counts on a fine scale of logarithms, highest first."""
    return sorted(((r.l, r.words) for r in counts.groupBy(level().alias("l")).agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)


def commonest(counts: DataFrame, most: int) -> list:
    """The ``most`` words of most counts (w, n), ties by w: a histogram of counts bounds what is sorted and sent."""
    found, least = 0, 0
    for least, words in levels(counts):
        found += words
        if found >= most:
            break
    return counts.filter(level() >= least).orderBy(F.desc("n"), "w").limit(most).collect()


def shares(counts: DataFrame, log_total: list[float], most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """A level, and hashes (sorted) and shares of all words from it on, at most ``most``; words below it are to be joined."""
    found, least = 0, 1 << 30
    for low, words in levels(counts):
        if found + words > most:
            break
        found, least = found + words, low
    table = counts.filter(level() >= least).select("w", share(log_total).alias("s")).toArrow()
    words, values = table.column("w").to_numpy(), table.column("s").to_numpy()
    order = np.argsort(words)
    return least, words[order], values[order]


def share(log_total: list[float]) -> F.Column:
    """The logarithm of a word's share of its bucket (w, n; n null: unseen), as a whole number of 1 / UNIT."""
    total = F.array(*map(F.lit, log_total))[bucket("w")]
    return F.round((F.log(F.coalesce("n", F.lit(1)).cast("double")) - total) * UNIT).cast("long")


def bucket(w: str) -> F.Column:
    """The hash bucket of a word, as ``numbers`` has it."""
    return F.shiftrightunsigned(F.col(w), 58)


def targets(n: int, turn: int) -> np.ndarray:
    """The words of a pass of ``n`` that a round trains on, in mixed order."""
    return np.random.default_rng(n).permutation(np.arange(turn, n, ROUNDS))


def averaged(docs: DataFrame, known, net: Network, text: str, turn: int) -> Network:
    """One round: every partition trains, and the networks are averaged block by block."""
    shared = docs.sparkSession.sparkContext.broadcast((known[:2], net.flat))
    schema = "part long, block int, weight double, x binary"

    def train(batches):
        known, flat = shared.value
        own, squares, seen = Network(flat.copy()), Network(np.zeros_like(flat)), 0
        for _, data, offsets in passes(batches, "_text", 1 << 21):
            hashes, first = word_hashes(data, offsets)
            word = numbers(known, hashes)
            if not len(word):
                continue
            context = contexts(word, first)
            at = targets(len(word), turn)
            for i in range(0, len(at), BATCH):
                step(own, squares, context[at[i : i + BATCH]], word[at[i : i + BATCH]])
            seen += len(at)
        if seen:
            blocks = [own.flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()), pa.array([float(seen)] * len(blocks)), pa.array(blocks, pa.binary())], names=["part", "block", "weight", "x"])

    def mean(group):
        weight = group.weight.to_numpy()
        values = sum(w * np.frombuffer(x, np.float32).astype(np.float64) for w, x in zip(weight, group.x, strict=True)) / weight.sum()
        return group.iloc[:1].assign(weight=weight.sum(), x=values.astype(np.float32).tobytes())

    trained = written(docs.select(F.col(text).alias("_text")).mapInArrow(train, schema), "networks")
    left = (trained.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        trained = trained.groupBy("block", F.floor(F.col("part") / FAN).alias("part")).applyInPandas(lambda key, g: mean(g.assign(part=key[1])), schema)
        left = -(-left // FAN)
    blocks = {r.block: r.x for r in trained.collect()}
    return Network(np.frombuffer(b"".join(blocks[b] for b in sorted(blocks)), np.float32).copy()) if blocks else net


def trained(docs: DataFrame, text: str = "text") -> tuple[tuple, Network]:
    known, net = vocabulary(docs, text), Network()
    for turn in range(ROUNDS):
        net = averaged(docs, known, net, text, turn)
    return known, net


def scored(docs: DataFrame, model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", most: int = HELD) -> DataFrame:
    """``keep``, n_words, log_likelihood (sum) and score (mean) of every row."""
    source = docs.select(*held(docs, keep, ("n_words", "log_likelihood", "score")), F.col(text).alias("_text"))
    rare = T.ArrayType(T.StructType([T.StructField("w", T.LongType()), T.StructField("c", T.LongType())]))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("_n", T.LongType()), T.StructField("_sum", T.DoubleType()), T.StructField("_shares", T.LongType()), T.StructField("_rare", rare)])
    *known, counts, totals = model[0]
    log_total = [float(np.log(t + 1)) for t in totals]
    _, *common = shares(counts, log_total, most)
    shared = docs.sparkSession.sparkContext.broadcast((known, model[1].flat, common))

    def run(batches):
        known, flat, (common, values) = shared.value
        net = Network(flat)
        for batch, data, offsets in passes(batches, "_text", 1 << 21):
            hashes, first = word_hashes(data, offsets)
            word = numbers(known, hashes)
            context = contexts(word, first)
            value = np.concatenate([log_probabilities(net, context[i : i + CHUNK], word[i : i + CHUNK]) for i in range(0, len(word), CHUNK)] or [np.zeros(0)])
            n = np.diff(first)
            text = np.repeat(np.arange(len(n)), n)
            total = np.bincount(text, value, len(n)).astype(np.float64)
            others = word >= WORDS - CLASSES
            text, hashes = text[others], hashes[others]
            at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
            there = common[at] == hashes if len(common) else np.zeros(len(hashes), bool)
            sums = np.concatenate(([0], np.cumsum(values[at[there]])))
            part = np.diff(sums[np.searchsorted(text[there], np.arange(len(n) + 1))])
            text, hashes = text[~there], hashes[~there]
            order = np.lexsort((hashes, text))
            text, hashes = text[order], hashes[order]
            head = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])))[: len(text)])
            each = pa.StructArray.from_arrays([pa.array(hashes[head]), pa.array(np.diff(np.append(head, len(text))).astype(np.int64))], names=["w", "c"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text[head], np.arange(len(n) + 1)).astype(np.int32)), each)
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n.astype(np.int64)), pa.array(total), pa.array(part.astype(np.int64)), lists], names=schema.names)

    made = written(source.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "sums")
    found = made.select("_row", F.explode("_rare").alias("e")).select("_row", "e.*").join(counts, "w", "left")
    joined = found.groupBy("_row").agg(F.sum(F.col("c") * share(log_total)).alias("_joined"))
    total = F.col("_sum") + (F.col("_shares") + F.coalesce("_joined", F.lit(0))) / UNIT
    return made.drop("_rare").join(joined, "_row", "left").select(*source.columns[:-1], F.col("_n").alias("n_words"), total.alias("log_likelihood"), (total / F.greatest(F.col("_n"), F.lit(1))).alias("score"))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    return scored(docs, trained(docs))
