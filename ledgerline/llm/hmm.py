"""A hidden Markov language model, trained by Baum-Welch over the whole corpus.

Tokens are words and one end mark. The vocabulary grows with the corpus, so the latent states emit
one of a bounded number of word classes: each frequent word is a class of its own, every other word
falls into one of ``SUFFIX_CLASSES`` classes by its last three bytes; within its class a word has its
smoothed relative frequency. The probability of a text is that of its class sequence under the HMM,
by the scaled forward recursion, times the words' probabilities within their classes.

1. Word counts over all training texts (a Counter a batch, then an aggregate with map-side partials).
2. Every text is encoded once as class numbers and written. Counts of the ``HEAD_WORDS`` most frequent
   words (a bound; the table reaches the tasks as a broadcast) are looked up at once; the distinct rarer
   words of a text join the written counts, with no bound on their number.
3. Baum-Welch: each task sums expected transitions and emissions of its texts, which are added up by
   an aggregate to states x classes numbers. The start is a mixture of unigram models over pieces of
   at most ``SEGMENT`` tokens, fitted in the same way on all training texts, of whatever length; its
   components become the states.
4. One more pass computes the likelihoods.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .common import id_fold, id_text

STATES, ITERATIONS = 8, 3
CLASS_WORDS, SUFFIX_CLASSES, HEAD_WORDS = 16_000, 512, 120_000
MIXTURE_ROUNDS, SEGMENT = 8, 16                # of the start
MIXTURE_PRIOR = 1_500.0         # weight of the class unigram in each component
TILT, STATE_TILT = 2.0, 0.5     # spread of the class weights that tell the components, then the states apart
ADD = 0.1                       # added to a word's count
PRIOR = 20.0                    # weight of the class unigram in each state's emissions
_GROUP = 400_000                # padded tokens in one run of the recursion
END = b""                       # no word is empty, so this stands for the end mark


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX_CLASSES


# ------------------------------------------------------------------ the recursion (numpy)

class Hmm:
    """start (K,), move (K, K), emit (classes, K): P(class | state) by row of classes."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    def groups(self, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text numbers, class numbers in time order, texts still running at each time): the longest first."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = int(lengths[order[at]])
            many = order[at: at + max(1, _GROUP // max(1, longest))]
            at += len(many)
            padded = np.zeros((longest, len(many)), np.int32)
            for column, i in enumerate(many):
                padded[: lengths[i], column] = texts[i]
            running = (lengths[many][None, :] > np.arange(longest)[:, None])
            yield many, padded[running], running.sum(axis=1)

    def forward(self, seen: np.ndarray, running: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(emission row of each token, scaled forward values, scales), in time order."""
        emitted = self.emit[seen]
        alpha, scale = np.empty_like(emitted), np.empty(len(seen))
        at, a = 0, None
        for n in running:
            a = (self.start if a is None else a[:n] @ self.move) * emitted[at: at + n]
            total = a.sum(axis=1)
            a /= total[:, None]
            alpha[at: at + n], scale[at: at + n] = a, total
            at += n
        return emitted, alpha, scale

    def log10_likelihoods(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(texts))
        for many, seen, running in self.groups(texts):
            _, _, scale = self.forward(seen, running)
            column = np.concatenate([np.arange(n) for n in running])
            out[many] = np.bincount(column, weights=np.log10(scale), minlength=len(many))
        return out

    def expected(self, texts: list[np.ndarray], into: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """Adds the expected starts (K,), moves (K, K) and emissions (classes, K) of the texts."""
        starts, moves, emissions = into
        k = len(self.start)
        for many, seen, running in self.groups(texts):
            emitted, gamma, scale = self.forward(seen, running)
            ends = np.cumsum(running)
            b = np.ones((len(many), k))
            cross = np.zeros((k, k))
            for t in range(len(running) - 1, -1, -1):
                n, here = running[t], ends[t] - running[t]
                if t + 1 < len(running):
                    more, after = running[t + 1], ends[t]
                    w = emitted[after: after + more] * b[:more]
                    w /= scale[after: after + more, None]
                    cross += gamma[here: here + more].T @ w
                    b[:more] = w @ self.move.T
                gamma[here: here + n] *= b[:n]          # from here on the posterior
            starts += gamma[: running[0]].sum(axis=0)
            moves += self.move * cross
            for state in range(k):
                emissions[:, state] += np.bincount(seen, weights=gamma[:, state], minlength=len(emissions))


def normalised(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray, unigram: np.ndarray) -> Hmm:
    """The M-step: expected counts to probabilities; ``unigram`` (classes,) smooths the emissions."""
    emit = emissions + PRIOR * unigram[:, None]
    return Hmm((starts + 1) / (starts + 1).sum(), (moves + 1) / (moves + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def tilted(emissions: np.ndarray, spread: float, seed: int = 3) -> np.ndarray:
    """``emissions`` (classes, K) with fixed uneven weights by class and state: equal states would stay equal."""
    weights = np.random.default_rng(seed).normal(0.0, spread, emissions.shape)
    return emissions * np.exp(weights)


class Mixture:
    """Unigram components of pieces of texts. weight (K,), emit (classes, K): P(class | component)."""

    def __init__(self, weight: np.ndarray, emit: np.ndarray):
        self.log_weight, self.log_emit = np.log(weight), np.log(emit)

    def expected(self, texts: list[np.ndarray], into: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """Adds the expected pieces (K,) and emissions (classes, K) of the texts."""
        if not texts:
            return
        weights, _, emissions = into
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        seen = np.concatenate(texts)
        first = np.concatenate([np.arange(end - n, end, SEGMENT) for n, end in zip(lengths, ends, strict=True)])
        first = np.append(first, len(seen))
        many = max(1, _GROUP // SEGMENT)
        for at in range(0, len(first) - 1, many):
            cut = first[at: at + many + 1]
            part, sizes = seen[cut[0]: cut[-1]], np.diff(cut)
            log_p = np.add.reduceat(self.log_emit[part], cut[:-1] - cut[0], axis=0) + self.log_weight
            # tempered by length, or the first draw would already fix every piece
            log_p /= np.sqrt(sizes)[:, None]
            share = np.exp(log_p - log_p.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            weights += share.sum(axis=0)
            for k in range(len(weights)):
                emissions[:, k] += np.bincount(part, weights=np.repeat(share[:, k], sizes), minlength=len(emissions))


def mixture_start(sums: Callable[[Mixture], tuple[np.ndarray, np.ndarray]], unigram: np.ndarray, states: int, rounds: int = MIXTURE_ROUNDS) -> Hmm:
    """Unigram components of all texts' pieces as states that mostly stay. ``sums`` gives a mixture's
    expected pieces and emissions over the texts."""
    even = np.repeat(unigram[:, None], states, axis=1)
    weights, emissions = np.zeros(states), np.zeros((len(unigram), states))
    first = tilted(even, TILT)
    mixture = Mixture(np.full(states, 1 / states), first / first.sum(axis=0))
    for _ in range(rounds):
        weights, emissions = sums(mixture)
        emit = emissions + MIXTURE_PRIOR * even
        mixture = Mixture((weights + 1) / (weights + 1).sum(), emit / emit.sum(axis=0))
    stay = 0.9
    moves = np.full((states, states), (1 - stay) / max(1, states - 1))
    np.fill_diagonal(moves, stay)
    h = normalised(weights, np.zeros((states, states)), emissions, unigram)
    emit = tilted(h.emit, STATE_TILT)
    return Hmm(h.start, moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


# ------------------------------------------------------------------ counts and encoding (Spark)

def word_counts(texts: DataFrame) -> DataFrame:
    """(word, suffix, c) over the texts, the end mark included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for raw in batch.column(0).to_pylist():
                counts.update(raw.lower().split())
            counts[END] += batch.num_rows
            words = list(counts)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([suffix_class(w) for w in words], pa.int32()),
                                              pa.array(list(counts.values()), pa.int64())], names=["word", "suffix", "c"])

    each = texts.select("text").mapInArrow(run, "word binary, suffix int, c bigint")
    return each.groupBy("word", "suffix").agg(F.sum("c").alias("c")).where("c > 0")


def count_limits(vocabulary: DataFrame, sizes: tuple[int, ...]) -> list[int]:
    """For each size, the least count such that no more words than that have it. Words are counted by
    eighths of powers of two, so the histogram has a few hundred rows at most."""
    bins = vocabulary.select(F.floor(F.log2("c") * 8).alias("bin")).groupBy("bin").count().orderBy(F.desc("bin")).collect()
    out = []
    for size in sizes:
        total, limit = 0, None
        for r in bins:
            if total + r["count"] > size:
                break
            total, limit = total + r["count"], r["bin"]
        # the least whole number in the bin
        out.append(max(1, math.ceil(2 ** (limit / 8) - 1e-9)) if limit is not None else 2**62)
    return out


class Lexicon:
    """What a task needs to know of the vocabulary; bounded by ``HEAD_WORDS``."""

    def __init__(self, head: list[tuple[bytes, int]], class_limit: int, tokens: int, distinct: int, suffix_stats: dict[int, tuple[int, int]]):
        self.tokens, self.distinct = tokens, distinct
        self.denominator = tokens + ADD * (distinct + 1)
        # log10 of what divides a word's count + ADD within its suffix class
        self.suffix_log = np.full(SUFFIX_CLASSES, math.log10(ADD))
        for suffix, (c, v) in suffix_stats.items():
            self.suffix_log[suffix] = math.log10(c + ADD * (v + 1))
        own = [w for w, c in head if c >= class_limit or w == END]
        self.classes = len(own) + SUFFIX_CLASSES
        number = {w: i for i, w in enumerate(own)}
        self.ids = {w: i for i, (w, _) in enumerate(head)}
        counts = np.array([c for _, c in head], float)
        self.word_class = np.array([number.get(w, len(own) + suffix_class(w)) for w, _ in head], np.int64)
        self.known = counts > 0                 # all but the end mark of an empty training set
        self.base = np.log10((counts + ADD) / self.denominator) if len(head) else np.zeros(0)
        self.inside = np.array([0.0 if w in number else math.log10(c + ADD) - self.suffix_log[suffix_class(w)] for w, c in head])
        self.unigram = np.zeros(self.classes)
        for (w, c), k in zip(head, self.word_class, strict=True):
            if w in number:
                self.unigram[k] += c
        for suffix, (c, _) in suffix_stats.items():
            self.unigram[len(own) + suffix] += c
        self.unigram = (self.unigram + ADD) / (self.unigram + ADD).sum()


class _Places(dict):
    """Word to head place, or -1 - suffix class for a word outside the head."""

    def __missing__(self, word: bytes) -> int:
        return -1 - suffix_class(word)


_ENCODED = ("row bigint, n_tokens bigint, n_known bigint, base double, inside double, n_rare bigint, "
            "classes binary, rare array<binary>, rare_counts array<bigint>")


def encode(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``texts`` (doc_id, held_out, text) to class numbers, sums over head words, and the distinct rarer
    words with their counts in the text."""
    schema = T.StructType([texts.schema["doc_id"], texts.schema["held_out"], *T.StructType.fromDDL(_ENCODED).fields])
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lex = shared.value
        places = _Places(lex.ids)
        end, first = lex.ids[END], lex.classes - SUFFIX_CLASSES
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for raw in batch.column(2).to_pylist():
                words = raw.lower().split()
                at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                at = np.append(at, end)
                head, tail = at[at >= 0], np.flatnonzero(at < 0)
                classes = np.where(at >= 0, lex.word_class[np.maximum(at, 0)], first - 1 - at).astype(np.uint16)
                rare = Counter([words[i] for i in tail])
                got = [row, len(at), int(lex.known[head].sum()), lex.base[head].sum() - len(tail) * math.log10(lex.denominator),
                       lex.inside[head].sum() - lex.suffix_log[-1 - at[tail]].sum(), len(tail), classes.tobytes(), list(rare), list(rare.values())]
                row += 1
                for column, value in zip(out, got, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=schema.names)

    return texts.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def rare_sums(encoded: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(rare_row, rare_known, rare_log): by text, the known rarer tokens and the sum of log10(c + ADD)."""
    each = encoded.where("n_rare > 0").select("row", F.explode(F.arrays_zip("rare", "rare_counts")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.rare_counts").alias("times"))
    met = each.join(vocabulary.select("word", "c"), "word", "left")
    return met.groupBy(F.col("row").alias("rare_row")).agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + ADD)).alias("rare_log"))


def _texts_of(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in batch.column(column).to_pylist()]


def expected_sums(encoded: DataFrame, model: Hmm | Mixture, states: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``model.expected`` adds up over all training texts. What reaches the driver has classes x states numbers."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))
        for batch in batches:
            shared.value.expected(_texts_of(batch, 0), into)
        table = np.vstack([into[0][None, :], into[1], into[2]])
        used = np.flatnonzero(table.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *(pa.array(table[used, k]) for k in range(states))],
                                         names=["place", *(f"s{k}" for k in range(states))])

    spec = "place bigint, " + ", ".join(f"s{k} double" for k in range(states))
    sums = (encoded.where("not held_out").select("classes").mapInArrow(run, spec)
            .groupBy("place").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]).toPandas())
    table = np.zeros((1 + states + classes, states))
    table[sums["place"].to_numpy()] = sums.drop(columns="place").to_numpy()
    return table[0], table[1: 1 + states], table[1 + states:]


def baum_welch_round(encoded: DataFrame, hmm: Hmm, unigram: np.ndarray) -> Hmm:
    """One iteration over all training texts."""
    return normalised(*expected_sums(encoded, hmm, len(hmm.start), len(unigram)), unigram)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0,
                states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose id does not fall into the held-out fold (a null id does not).
    A null or empty text is its end mark alone; repeated rows count and are scored each; if there is no
    training text, nothing is known and both scores are those of an empty vocabulary.
    """
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col, binary=True).withColumn(
        "held_out", F.coalesce(id_fold("doc_id", folds) == held_fold, F.lit(False)))
    vocabulary = stage_table(word_counts(texts.where("not held_out")), "vocabulary")
    size = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = int(size[0]), int(size[1])
    class_limit, head_limit = count_limits(vocabulary, (CLASS_WORDS, HEAD_WORDS))
    head = {bytes(r["word"]): int(r["c"]) for r in vocabulary.where((F.col("c") >= head_limit) | (F.col("word") == F.lit(END))).collect()}
    head.setdefault(END, 0)
    stats = vocabulary.where((F.col("c") < class_limit) & (F.col("word") != F.lit(END))).groupBy("suffix").agg(F.sum("c"), F.count(F.lit(1))).collect()
    lexicon = Lexicon(sorted(head.items()), class_limit, tokens, distinct, {r[0]: (int(r[1]), int(r[2])) for r in stats})

    encoded = stage_table(encode(texts, lexicon), "encoded")
    classes = len(lexicon.unigram)
    # without a training text nothing is learned, and the rounds would read an empty table
    learned = tokens > 0
    hmm = mixture_start(lambda mixture: expected_sums(encoded, mixture, states, classes)[::2], lexicon.unigram, states, MIXTURE_ROUNDS if learned else 0)
    for _ in range(iterations if learned else 0):
        hmm = baum_welch_round(encoded, hmm, lexicon.unigram)

    shared = spark.sparkContext.broadcast(hmm)
    schema = T.StructType([encoded.schema[c] for c in ("doc_id", "held_out", "row", "n_tokens", "n_known", "base", "inside")]
                          + [T.StructField("latent", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latent = shared.value.log10_likelihoods(_texts_of(batch, 7))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(latent, pa.float64())], names=schema.names)

    latent = encoded.select("doc_id", "held_out", "row", "n_tokens", "n_known", "base", "inside", "classes").mapInArrow(run, schema)
    sums = rare_sums(encoded, vocabulary.where(F.col("c") < head_limit))
    rare = F.coalesce(F.col("rare_log"), F.lit(0.0))
    return (latent.join(sums, latent["row"] == sums["rare_row"], "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("base") + rare).alias("base_score"),
                    (F.col("latent") + F.col("inside") + rare).alias("score")))
