"""Language identification: a linear-chain conditional random field over words.

Every word of a text gets a distribution over the learned languages by
forward-backward, so code-switched text is labelled word by word; a text's
language is the one with most posterior mass.  A word is a run of ASCII
letters and non-ASCII bytes, lower-cased.  Its emission sums the weights of
its byte 1- to 4-grams, of its prefixes and suffixes up to three bytes, and
its lexicon entry (centred log frequencies by language).  Transitions are
learned.  A chain is a sentence or line, of at most ``CHAIN`` words; longer
runs go on in a new chain, no word is left out.

Training takes whole texts of about ``PER_LANGUAGE`` labelled documents per
language (chosen by a hash of doc_id), cut into stretches that are strung
together across languages, so that switches occur and transitions have
evidence.  A null text, one without a letter, or any text when nothing was
learned gives ``und`` with score 0.  Equal texts get equal labels, rows without doc_id
are labelled like others, no rows give no rows, and a kept column with a made
one's name becomes ``<name>_in``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import LOWER, held, passes, prefix_hash, span_hash

PER_LANGUAGE = 150
CHAIN = 128
BUCKETS = 1 << 16
EPOCHS = 3
RATE = 0.2
LEXICON_COUNT = 3

_IN_WORD = np.zeros(256, bool)
_IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 63]] = True
_SALTS = np.random.default_rng(11).integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    lexicon_words: np.ndarray  # sorted hashes
    lexicon: np.ndarray  # by word and language
    lexicon_weight: float
    transitions: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals to small letters, on UTF-8 bytes."""
    low = LOWER[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    low[capital] += 0x20
    return low


def words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes; starts, ends and chain starts (as word numbers) of the words; words before each text."""
    inside = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside))[:-1]
    after = np.concatenate((inside[1:], [False]))[: len(data)]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    stops = np.concatenate(([0], np.cumsum(_STOP[data])))
    first = np.searchsorted(starts, offsets)
    fresh = np.zeros(len(starts) + 1, bool)
    fresh[first] = True
    if len(starts):
        fresh[0] = True
        fresh[1:-1] |= stops[starts[1:]] > stops[ends[:-1]]
        chains = np.flatnonzero(fresh[:-1])
        lengths = np.diff(np.append(chains, len(starts)))
        extra = (lengths - 1) // CHAIN
        if extra.any():
            number = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1
            fresh[np.repeat(chains, extra) + number * CHAIN] = True
    return lowered(data), starts, ends, np.flatnonzero(fresh[:-1]), first


def features(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words, word by word, and where each word's begin."""
    size = ends - starts
    word = np.repeat(np.arange(len(starts)), size)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + starts[word]
    left = ends[word] - at
    codes = low.astype(np.uint64)
    found, owner = [], []
    gram = np.zeros(len(at), np.uint64)
    for n in range(4):
        ok = left > n
        gram = gram * np.uint64(257) + np.where(ok, codes[np.minimum(at + n, len(low) - 1)], 0).astype(np.uint64) + np.uint64(1)
        found.append((gram * _SALTS[n])[ok])
        owner.append(word[ok])
    each = np.arange(len(starts))
    for salt, step in ((4, 1), (8, -1)):
        gram = np.zeros(len(starts), np.uint64)
        for n in range(3):
            ok = size > n
            place = starts + n if step > 0 else ends - 1 - n
            gram = gram * np.uint64(257) + np.where(ok, codes[np.clip(place, 0, max(len(low) - 1, 0))], 0).astype(np.uint64) + np.uint64(1)
            found.append((gram * _SALTS[salt + n])[ok])
            owner.append(each[ok])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    index = (np.concatenate(found)[order] >> np.uint64(48)).astype(np.int64)
    return index, np.searchsorted(owner[order], each)


def entries(model: Field, hashes: np.ndarray) -> np.ndarray:
    """Lexicon rows of words; zero for words outside."""
    out = np.zeros((len(hashes), len(model.languages)), np.float32)
    if len(model.lexicon_words):
        at = np.minimum(np.searchsorted(model.lexicon_words, hashes), len(model.lexicon_words) - 1)
        known = model.lexicon_words[at] == hashes
        out[known] = model.lexicon[at[known]]
    return out


def emissions(model: Field, low, starts, ends, hashes) -> np.ndarray:
    index, at = features(low, starts, ends)
    return np.add.reduceat(model.weights[index], at, axis=0) + model.lexicon_weight * entries(model, hashes)


def steps(chains: np.ndarray, total: int):
    """Word numbers of all chains' first, second ... words, longest chains first."""
    lengths = np.diff(np.append(chains, total))
    order = np.argsort(-lengths, kind="stable")
    heads, lengths = chains[order], lengths[order]
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    return [heads[:n] + t for t, n in enumerate(alive.tolist())]


def posteriors(model: Field, emission: np.ndarray, chains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once: word marginals, and summed transition marginals."""
    tall = np.exp(emission - emission.max(axis=1, keepdims=True))
    moves = np.exp(model.transitions)
    order = steps(chains, len(emission))
    alpha, beta = np.empty_like(tall), np.ones_like(tall)
    for t, at in enumerate(order):
        now = tall[at] if t == 0 else (alpha[at - 1] @ moves) * tall[at]
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(moves)
    for at in reversed(order[1:]):
        ahead = beta[at] * tall[at]
        joint = alpha[at - 1].T @ (ahead / np.maximum((alpha[at - 1] @ moves * ahead).sum(axis=1, keepdims=True), 1e-30))
        pairs += joint * moves
        back = ahead @ moves.T
        beta[at - 1] = back / back.sum(axis=1, keepdims=True)
    both = alpha * beta
    return both / both.sum(axis=1, keepdims=True), pairs


def fit(texts: list[tuple[str, str]], seed: int = 5) -> Field | None:
    """Learn from (language, text) pairs by stochastic gradient on the conditional likelihood."""
    languages = sorted({x for x, _ in texts})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    raw = [t.encode() for _, t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return None
    low, starts, ends, _, first = words(data, offsets)
    if not len(starts):
        return None
    label = np.repeat([languages.index(x) for x, _ in texts], np.diff(first))
    hashes = span_hash(prefix_hash(low), starts, ends)
    kinds, example, kind = np.unique(hashes, return_index=True, return_inverse=True)
    counts = np.stack([np.bincount(kind, label == k, len(kinds)) for k in range(len(languages))], axis=1)
    often = counts.sum(axis=1) >= LEXICON_COUNT
    share = np.log((counts[often] + 0.5) / (counts.sum(axis=0) + 0.5 * len(kinds)))
    model = Field(languages, np.zeros((BUCKETS, len(languages)), np.float32), kinds[often], (share - share.mean(axis=1, keepdims=True)).astype(np.float32), 0.2, np.zeros((len(languages),) * 2, np.float32))
    index, at = features(low, starts[example], ends[example])
    spread = np.diff(np.append(at, len(index)))
    entry = entries(model, kinds)
    stretches = []  # of words in one language, strung together in random order
    i = 0
    cuts = rng.integers(4, 24, len(starts))
    for b in first[1:].tolist():
        while i < b:
            stretches.append((i, min(b, i + int(cuts[len(stretches) % len(cuts)]))))
            i = stretches[-1][1]
    squares = np.full(model.weights.shape, 1e-4, np.float32)
    for _ in range(EPOCHS):
        strung = np.concatenate([np.arange(*stretches[i]) for i in rng.permutation(len(stretches))])
        for part in np.array_split(strung, max(1, len(strung) // 8192)):
            chains = np.arange(0, len(part), 48)
            score = np.add.reduceat(model.weights[index], at, axis=0)[kind[part]] if len(part) > len(kinds) else emit(model, index, at, spread, kind[part])
            marginal, pairs = posteriors(model, score + model.lexicon_weight * entry[kind[part]], chains)
            gold = np.eye(len(languages), dtype=np.float32)[label[part]]
            error = (marginal - gold).astype(np.float32)
            used, where = np.unique(kind[part], return_inverse=True)
            by_kind = np.stack([np.bincount(where, error[:, k], len(used)) for k in range(len(languages))], axis=1).astype(np.float32)
            places = gathered(at[used], spread[used])
            rows, slot = np.unique(index[places], return_inverse=True)
            each = np.repeat(by_kind, spread[used], axis=0)
            gradient = np.stack([np.bincount(slot, each[:, k], len(rows)) for k in range(len(languages))], axis=1).astype(np.float32) / len(part) * 100
            squares[rows] += gradient**2
            model.weights[rows] -= RATE * gradient / np.sqrt(squares[rows])
            model.lexicon_weight = max(0.0, model.lexicon_weight - 0.05 * float((error * entry[kind[part]]).sum() / len(part)))
            inner = np.flatnonzero(np.arange(len(part)) % 48)
            seen = np.zeros_like(pairs)
            np.add.at(seen, (label[part][inner - 1], label[part][inner]), 1)
            model.transitions -= (2.0 * (pairs - seen) / max(len(inner), 1)).astype(np.float32)
    return model


def gathered(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``at[i] .. at[i] + size[i]`` one after the other."""
    return np.arange(int(size.sum())) + np.repeat(at - (np.cumsum(size) - size), size)


def emit(model: Field, index, at, spread, kind) -> np.ndarray:
    used, where = np.unique(kind, return_inverse=True)
    sizes = spread[used]
    return np.add.reduceat(model.weights[index[gathered(at[used], sizes)]], np.cumsum(sizes) - sizes, axis=0)[where]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Field | None:
    """Fit on a bounded sample of the labelled rows of ``docs``."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])[F.col("lang")]
    rows = labelled.filter(share < rate).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text").limit(4 * per_language * len(counts)).collect()
    return fit([(r.lang, r.text) for r in sorted(rows, key=lambda r: (r.doc_id or 0, r.text))])


def labelled(docs: DataFrame, model: Field | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and lang_pred, score, n_words, n_switches (changes of language along chains)."""
    made = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("n_words", T.LongType()), ("n_switches", T.LongType())]
    source = docs.select(*held(docs, keep, [n for n, _ in made]), F.col(text).alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(*x) for x in made]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        field = shared.value
        for batch, data, offsets in passes(batches, "_text"):
            n = batch.num_rows
            mass, switches, n_words = np.zeros((n, max(1, len(field.languages) if field else 1))), np.zeros(n, np.int64), np.zeros(n, np.int64)
            low, starts, ends, chains, first = words(data, offsets)
            if field and len(starts):
                hashes = span_hash(prefix_hash(low), starts, ends)
                _, example, kind = np.unique(hashes, return_index=True, return_inverse=True)
                emission = emissions(field, low, starts[example], ends[example], hashes[example])[kind]
                marginal, _ = posteriors(field, emission, chains)
                row = np.repeat(np.arange(n), np.diff(first))
                mass = np.stack([np.bincount(row, marginal[:, k], n) for k in range(marginal.shape[1])], axis=1)
                n_words = np.diff(first)
                best = marginal.argmax(axis=1)
                change = np.concatenate(([False], best[1:] != best[:-1]))
                change[chains] = False
                switches = np.bincount(row, change, n).astype(np.int64)
            letters = np.zeros(n, bool)
            ascii_letters = np.concatenate(([0], np.cumsum(_IN_WORD[data] & (data < 128))))
            letters = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
            for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)).tolist():
                letters[i] = any(map(str.isalpha, bytes(data[offsets[i] : offsets[i + 1]]).decode()))
            letters &= n_words > 0
            total = np.maximum(mass.sum(axis=1), 1e-9)
            top = mass.argmax(axis=1)
            langs = [field.languages[k] if ok else "und" for k, ok in zip(top.tolist(), letters.tolist(), strict=True)] if field else ["und"] * n
            value = np.where(letters, mass[np.arange(n), top] / total, 0.0).clip(0, 1)
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(langs, pa.string()), pa.array(value), pa.array(n_words.astype(np.int64)), pa.array(switches)], names=schema.names)

    return source.mapInArrow(run, schema)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """The contract's row per document; learns from the rows that are not held out."""
    model = train(docs.filter(~held_out()))
    out = labelled(docs, model, ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
