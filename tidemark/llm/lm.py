"""Language-model scoring: a log-bilinear model trained in numpy with noise-contrastive estimation.

Symbols. Words and one end token a text are counted over all training texts. The most frequent words are symbols of
their own; every other word belongs to the class of its last two bytes (the most frequent endings, and one class for
the rest). A word's probability is that of its symbol, times, in a class, its smoothed share of the class:
(c + 0.5) / (C + 0.5 (V + 1)), where one share is kept for unseen words. So all probabilities of a place add up to 1.

Model. The vectors of the symbols before a place, weighted by position, add up to a prediction; its products with the
output vectors, plus biases, are logits. With two symbols before a place there are few different ones, so the sum that
normalises is taken once for each pair a task meets. Training by noise-contrastive estimation tells each true symbol from noise
drawn from the unigram distribution, and never needs the sum over all symbols; scoring takes that sum, by batched matrix
products, so its log-probabilities are normalised.

At scale. Each task trains on the training texts of its partition, starting from the same parameters; the results are
averaged by a grouped sum, weighted by tokens, and the next round starts from there. Rounds take growing parts of the
texts, so that every training text is used once. Parameters (some 17,000 numbers) and the table of frequent words (at
most ``FREQUENT`` of at most ``LONGEST`` + 1 bytes) are all that the driver and the tasks hold; counts of all other
words come to their texts by a join. A frequent word is frequent in all texts, so no hot word is left for that join.

Defined results: a NULL or empty text is the end token alone; a NULL id counts as the empty text for the split; equal
rows are scored alike, each on its own; words over ``LONGEST`` bytes are told apart by their 128-bit digest; with no
training text the counts are zero and the model keeps its first parameters; an empty table gives an empty table.
Scores depend on how the texts are dealt to partitions, as training does; with equal partitions a rerun agrees.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, small_batches
from tidemark.session import stored_table

#: Symbols: words of their own and classes of endings, the end token aside.
HEAD, CLASSES = 447, 64
#: Words before a place that the model sees, length of a symbol's vector, noise symbols a batch, places a batch.
CONTEXT, WIDTH, NOISE, BATCH = 2, 16, 32, 512
RATE, SEED = 0.1, 12
#: Places that a task gathers and mixes before it trains on them.
GATHERED = 128 * BATCH
#: Of 64 parts of the training texts, where each round ends.
ROUNDS = (2, 12, 64)
#: Words whose counts go to every task, and how long a word stands as it is.
FREQUENT, LONGEST = 131_072, 64
#: Distinct words a task gathers before it hands on their counts.
HELD_WORDS = 400_000
#: No word holds white space, so these can't clash with one: the end token, and the mark of a digest.
END, DIGEST = b"\n", b" "


def word_key(word: bytes) -> bytes:
    """The word, or its marked digest if it is long."""
    return word if len(word) <= LONGEST else DIGEST + xxhash.xxh3_128_digest(word)


def ending(key: bytes) -> bytes:
    return DIGEST if key[:1] == DIGEST else key[-2:]


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end token."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words if max(map(len, words)) <= LONGEST else [*map(word_key, words)]


def held_out(key: str, folds: int = 5, fold: int = 1) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(folds)) == fold


# --- counts ---


def count_words(docs: DataFrame) -> DataFrame:
    """(word, train, n): how often each word stands in training texts and in all; ``docs`` has (t, held)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, rest = Counter(), Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(train.keys() | rest.keys())
            for s in range(0, len(words), 50_000):
                part = words[s : s + 50_000]
                own = [train[w] for w in part]
                yield pa.record_batch([pa.array(part, pa.binary()), pa.array(own, pa.int64()), pa.array([a + rest[w] for a, w in zip(own, part)], pa.int64())], ["word", "train", "n"])
            train.clear()
            rest.clear()

        for batch in batches:
            for t, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (rest if held else train).update(words_of(t))
                if len(train) + len(rest) > HELD_WORDS:
                    yield from flush()
        yield from flush()

    small_batches(docs.sparkSession)
    counted = docs.select("t", "held").mapInArrow(run, "word binary, train long, n long")
    return counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task knows: bounded by ``FREQUENT``, ``HEAD`` and ``CLASSES``, not by the corpus."""

    tokens: int  # N
    types: int  # V
    frequent: dict[bytes, int]  # training counts
    symbols: dict[bytes, int]  # end token 0, head words, then classes by ending
    classes: dict[bytes, int]
    last: int  # the class of all other endings
    counts: np.ndarray  # training tokens of each symbol
    share: np.ndarray  # log10 of a class's C + 0.5 (V + 1), 0 for the other symbols

    def __post_init__(self) -> None:
        self.place = {w: i for i, w in enumerate(self.frequent)}
        train = np.fromiter(self.frequent.values(), dtype=np.float64, count=len(self.frequent))
        self.train, self.log_train = train.astype(np.int64), np.log10(train + 0.5)
        self.symbol_at = np.fromiter(map(self.symbol, self.frequent), dtype=np.int64, count=len(self.frequent))

    def symbol(self, word: bytes) -> int:
        found = self.symbols.get(word)
        return self.classes.get(ending(word), self.last) if found is None else found

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols, places in ``frequent`` or -1, which words are rare)."""
        get = self.place.get
        at = np.array([get(w, -1) for w in words], dtype=np.int64)
        symbols = self.symbol_at[at] if len(self.symbol_at) else np.zeros(len(at), dtype=np.int64)
        rare = np.flatnonzero(at < 0)
        symbols[rare] = [self.symbol(words[i]) for i in rare.tolist()]
        return symbols, at, rare


def learn_vocabulary(counted: DataFrame, head: int = HEAD, classes: int = CLASSES, frequent: int = FREQUENT) -> Vocabulary:
    """Totals, frequent words and classes from the stored counts. The driver sees bounded tables only."""
    seen = F.col("train") > 0
    tokens, types = counted.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count(F.when(seen, 1))).first()
    # The bound on the count is found on its logarithm's histogram, so nothing is sorted and no task holds all words.
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True)
    room, least = frequent, None
    for at, words in sizes:
        if words > room:
            break
        room, least = room - words, at
    often = F.lit(False) if least is None else step >= least
    ends_texts = F.col("word") == F.lit(bytearray(END))  # the end token is a symbol, however few texts there are
    known = {bytes(r["word"]): r["train"] for r in counted.where(often | ends_texts).collect()}
    own = sorted((w for w, c in known.items() if c and w != END and w[:1] != DIGEST), key=lambda w: (-known[w], w))[:head]
    symbols = {w: i for i, w in enumerate([END, *own])}
    # Endings have two bytes at most, so their table is bounded as well.
    long = F.substring("word", 1, 1) == F.lit(bytearray(DIGEST))
    tail = F.when(long, F.lit(bytearray(DIGEST))).otherwise(F.substring("word", -2, 2))
    ends = {bytes(r[0]): [r[1], r[2]] for r in counted.groupBy(tail).agg(F.sum("train"), F.count(F.when(seen, 1))).collect()}
    for w in symbols:
        if w in known and ending(w) in ends:
            of = ends[ending(w)]
            of[0], of[1] = of[0] - known[w], of[1] - (known[w] > 0)
    ranked = sorted((e for e in ends if ends[e][0] > 0), key=lambda e: (-ends[e][0], e))[: classes - 1]
    places = {e: len(symbols) + i for i, e in enumerate(ranked)}
    last = len(symbols) + len(ranked)
    counts, share = np.zeros(last + 1), np.zeros(last + 1)
    within = np.zeros((last + 1, 2))
    for e, of in ends.items():
        within[places.get(e, last)] += of
    counts[: len(symbols)] = [known.get(w, 0) for w in symbols]
    counts[len(symbols) :] = within[len(symbols) :, 0]
    share[len(symbols) :] = np.log10(within[len(symbols) :, 0] + 0.5 * (within[len(symbols) :, 1] + 1))
    return Vocabulary(tokens, types, known, symbols, places, last, counts, share)


# --- model ---


class LogBilinear:
    """Parameters of the model over ``n`` symbols; symbol ``n`` stands before a text's first word."""

    def __init__(self, n: int, context: int = CONTEXT, width: int = WIDTH) -> None:
        self.n, self.context, self.width = n, context, width
        shapes = [(n + 1, width), (context, width), (n, width), (n,)]
        self.values = np.zeros(sum(math.prod(s) for s in shapes), dtype=np.float32)
        views, at = [], 0
        for s in shapes:
            views.append(self.values[at : at + math.prod(s)].reshape(s))
            at += math.prod(s)
        self.seen, self.place, self.out, self.bias = views

    @classmethod
    def first(cls, counts: np.ndarray, context: int = CONTEXT, width: int = WIDTH, seed: int = SEED) -> LogBilinear:
        """Small seeded vectors, and biases at the unigram distribution: the model starts out as that."""
        model, draw = cls(len(counts), context, width), np.random.default_rng(seed)
        model.seen[:] = draw.normal(0, 0.1, model.seen.shape)
        model.out[:] = draw.normal(0, 0.1, model.out.shape)
        model.place[:] = 1.0
        model.bias[:] = np.log(unigram(counts))
        return model

    def predicted(self, before: np.ndarray) -> np.ndarray:
        return sum(self.seen[before[:, i]] * self.place[i] for i in range(self.context))

    def log_sums(self, before: np.ndarray, places: int = 256) -> np.ndarray:
        """The logarithm of what the exponentials of all symbols' logits add up to, by batched matrix products."""
        out = np.empty(len(before))
        for s in range(0, len(before), places):
            logits = self.predicted(before[s : s + places]) @ self.out.T
            logits += self.bias
            top = logits.max(axis=1)
            logits -= top[:, None]
            np.exp(logits, out=logits)
            out[s : s + places] = top + np.log(logits.sum(axis=1, dtype=np.float64))
        return out

    def log_probabilities(self, before: np.ndarray, target: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """log10 of each target's normalised probability.

        Places with the same symbols before them have the same sum over all symbols, so it is taken once for each;
        ``known`` (``memory``) keeps the sums from one call to the next.
        """
        known = self.memory() if known is None else known
        codes = before @ (self.n + 1) ** np.arange(self.context)
        fresh = np.unique(codes[np.isnan(known[codes])])
        known[fresh] = self.log_sums(np.stack([fresh // (self.n + 1) ** i % (self.n + 1) for i in range(self.context)], axis=1))
        hit = (self.predicted(before) * self.out[target]).sum(axis=1) + self.bias[target]
        return (hit - known[codes]) / math.log(10)

    def memory(self) -> np.ndarray:
        """Room for the sum after any symbols: (n + 1) ** context numbers, whatever the corpus."""
        return np.full((self.n + 1) ** self.context, np.nan)


def unigram(counts: np.ndarray) -> np.ndarray:
    return (counts + 0.5) / (counts + 0.5).sum()


class Trainer:
    """Noise-contrastive estimation by batches, with step sizes that adapt to each parameter."""

    def __init__(self, model: LogBilinear, counts: np.ndarray, noise: int = NOISE, rate: float = RATE, seed: int = SEED) -> None:
        self.model, self.noise, self.rate = model, noise, rate
        self.draw = np.random.default_rng(seed)
        share = unigram(counts)
        self.edges = np.cumsum(share)
        self.offset = np.log(noise * share).astype(np.float32)
        self.squares = LogBilinear(model.n, model.context, model.width)
        self.squares.values[:] = 1.0
        self.slope = LogBilinear(model.n, model.context, model.width)
        self.places = 0

    def _sum_rows(self, out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
        """out[rows] += values, rows repeating."""
        cells = (rows[:, None] * out.shape[1] + np.arange(out.shape[1])).ravel()
        out += np.bincount(cells, weights=values.ravel(), minlength=out.size).reshape(out.shape)

    def step(self, before: np.ndarray, target: np.ndarray) -> None:
        m, g = self.model, self.slope
        g.values[:] = 0
        noise = np.minimum(np.searchsorted(self.edges, self.draw.random(self.noise)), m.n - 1)
        vectors = [m.seen[before[:, i]] for i in range(m.context)]
        guess = sum(v * p for v, p in zip(vectors, m.place))
        own = m.out[target]
        true = (guess * own).sum(axis=1) + m.bias[target] - self.offset[target]
        false = guess @ m.out[noise].T + (m.bias[noise] - self.offset[noise])
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))  # 1 - P(true)
        down = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        back = up[:, None] * own + down @ m.out[noise]
        self._sum_rows(g.out, target, up[:, None] * guess)
        np.add.at(g.out, noise, down.T @ guess)
        g.bias += np.bincount(target, weights=up, minlength=m.n)
        np.add.at(g.bias, noise, down.sum(axis=0))
        for i in range(m.context):
            self._sum_rows(g.seen, before[:, i], back * m.place[i])
            g.place[i] = (back * vectors[i]).sum(axis=0)
        s = self.squares.values
        s += g.values * g.values
        m.values += self.rate * g.values / np.sqrt(s)
        self.places += len(target)

    def train(self, before: np.ndarray, target: np.ndarray) -> None:
        mixed = self.draw.permutation(len(target))
        for s in range(0, len(mixed), BATCH):
            part = mixed[s : s + BATCH]
            self.step(before[part], target[part])


def contexts(symbols: np.ndarray, start: int, context: int) -> tuple[np.ndarray, np.ndarray]:
    """(before, target) of a text's places: ``start`` stands before its first symbol."""
    padded = np.concatenate([np.full(context, start), symbols])
    return np.lib.stride_tricks.sliding_window_view(padded[:-1], context)[:, ::-1], symbols


def train_round(docs: DataFrame, words: Vocabulary, model: LogBilinear, low: int, high: int, parameters: dict | None = None) -> LogBilinear:
    """The average, weighted by tokens, of what the partitions make of ``model``; ``docs`` has (t, held, part)."""
    settings, width = parameters or {}, model.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = LogBilinear(model.n, model.context, model.width)
        mine.values[:] = model.values
        trainer = Trainer(mine, words.counts, **settings)
        held: list[np.ndarray] = []
        n = 0

        def learn() -> None:
            pairs = [contexts(x, model.n, model.context) for x in held]
            trainer.train(np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
            held.clear()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                symbols = words.look_up(words_of(t))[0]
                for s in range(0, len(symbols), GATHERED):  # a long text goes in pieces
                    held.append(symbols[s : s + GATHERED])
                    n += len(held[-1])
                    if n >= GATHERED:
                        learn()
                        n = 0
        if n:
            learn()
        if trainer.places:
            rows = np.zeros(-(-len(mine.values) // width) * width)
            rows[: len(mine.values)] = mine.values
            rows = rows.reshape(-1, width)
            yield pa.record_batch(
                [pa.array(np.arange(len(rows))), pa.array(np.full(len(rows), float(trainer.places))), *[pa.array(rows[:, i].copy()) for i in range(width)]],
                ["row", "weight", *[f"x{i}" for i in range(width)]],
            )

    texts = docs.where(~F.col("held") & (F.col("part") >= low) & (F.col("part") < high)).select("t")
    small_batches(docs.sparkSession)
    schema = "row long, weight double, " + ", ".join(f"x{i} double" for i in range(width))
    own = texts.mapInArrow(run, schema)
    mean = own.groupBy("row").agg(*[(F.sum(F.col("weight") * F.col(f"x{i}")) / F.sum("weight")).alias(f"x{i}") for i in range(width)])
    after = LogBilinear(model.n, model.context, model.width)
    found = mean.toPandas().sort_values("row")
    if not len(found):
        return model
    after.values[:] = found.drop(columns="row").to_numpy().ravel()[: len(after.values)]
    return after


# --- scores ---


def score_parts(docs: DataFrame, words: Vocabulary, model: LogBilinear, places: int = 16_384, entries: int = 65_536) -> DataFrame:
    """Sums over each text but for the rare words' counts, which stand beside them: (row, main, id, held, n_tokens, known, base, score, rare, times).

    ``row`` numbers a row of ``docs``; a text of many rare words takes several lines, of which one is ``main``.
    """
    base_total = math.log10(words.tokens + 0.5 * (words.types + 1))
    first_class = len(words.symbols)

    def rows(batch: dict) -> Iterator[tuple]:
        task = TaskContext.get().partitionId() << 33
        if not memory:
            memory.append(model.memory())
        for key, held, t in zip(batch["id"], batch["held"], batch["t"]):
            number, numbering[0] = task + numbering[0], numbering[0] + 1
            tokens = words_of(t)
            symbols, at, rare = words.look_up(tokens)
            before, target = contexts(symbols, model.n, model.context)
            score = sum(float(model.log_probabilities(before[s : s + places], target[s : s + places], memory[0]).sum()) for s in range(0, len(target), places))
            found = at[at >= 0]
            known = int((words.train[found] > 0).sum())
            base = float(words.log_train[found].sum())
            # In a class, a word has its share: its count goes to both scores, the class's total to the model's.
            score += float(words.log_train[at[(at >= 0) & (symbols >= first_class)]].sum()) - float(words.share[symbols].sum())
            left = list(Counter([tokens[i] for i in rare.tolist()]).items())
            for s in range(0, len(left), entries) if left else [0]:
                part, main = left[s : s + entries], s == 0
                sums = (len(tokens), known, base - len(tokens) * base_total, score) if main else (0, 0, 0.0, 0.0)
                yield (number, main, key, held, *sums, [w for w, _ in part], [n for _, n in part])

    memory: list[np.ndarray] = []
    numbering = [0]
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"row long, main boolean, id {kind}, held boolean, n_tokens long, known long, base double, score double, rare array<binary>, times array<long>"
    return map_rows(docs.select("id", "held", "t"), rows, schema)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", parameters: dict | None = None) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    own = F.col(key)
    narrow = docs.select(own.alias("id"), held_out(key).alias("held"), F.pmod(F.xxhash64(own, F.col(text)), F.lit(ROUNDS[-1])).alias("part"), F.col(text).alias("t"))
    counted = stored_table(count_words(narrow))
    words = learn_vocabulary(counted.table)
    model = LogBilinear.first(words.counts)
    for low, high in zip((0, *ROUNDS), ROUNDS):
        model = train_round(narrow, words, model, low, high, parameters)
    parts = stored_table(score_parts(narrow, words, model)).table
    # Rare words find their counts: each word has few texts, as all words of many texts are frequent.
    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    met = rare.join(counted.table.where(F.col("train") > 0).select("word", "train"), "word", "left")
    c = F.coalesce("train", F.lit(0))
    tails = met.groupBy("row").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"), F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_score"))
    whole = parts.where("main").drop("rare", "times").join(tails, "row", "left")
    extra = F.coalesce("rare_score", F.lit(0.0))
    return whole.select(
        F.col("id").alias(key),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )
