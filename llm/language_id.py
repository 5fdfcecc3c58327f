"""Language identification by segmentation-marginalised unigrams.

A public vocabulary of pieces is fixed; for every language a probability per
piece is learnt by expectation maximisation.  A word's probability is the sum
over *all* its segmentations into pieces (forward algorithm), a text's the
product over its words, and the score the posterior of the best language.

Pieces never cross white space, so each distinct word is evaluated once per
task and looked up afterwards.

Definitions for odd input: texts that are NULL or hold no letter get ``und``
with score 0; repeated rows are scored each on its own; extra columns are kept
out of the result; an empty table gives no rows; with nothing to learn from,
every text is ``und``.  Ties go to the language first in order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.session import parallelism
from llm.common import fields, hash_share, remainder, saved, text_groups

UNDETERMINED = "und"
ROWS_PER_LANG = 500         # rows each language is learnt from (expected number of the hash sample)
EM_ROUNDS = 3
UNIFORM_SHARE = 0.01        # probability mass spread evenly over the vocabulary
UNKNOWN = 1e-9              # probability of a character outside the vocabulary, the same for all languages
TRAIN_WORD_CHARS = 64       # longer "words" (of languages without blanks) are learnt from in pieces of this length
LONG_WORD = 1000            # characters from which a word is evaluated on its own
CACHED_WORDS = 200_000      # words a task remembers; others are evaluated again


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> dict[str, int]:
    """Pieces of a public vocabulary file, numbered; byte and control pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return {p: i for i, p in enumerate(dict.fromkeys(names))}


class Lattice:
    """All pieces of a word by place; sums over its segmentations.

    Words of one length are handled together as a matrix of code points.  The
    substrings that end at a place are looked up by a rolling 64-bit hash: a
    small bit table drops nearly all that are no pieces, a sorted search finds
    the others.
    """

    _STEP = np.uint64(0x9E3779B97F4A7C15)
    _BITS = 20

    def __init__(self, pieces: dict[str, int]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.unknown = len(pieces)          # one more row of the probability table
        names = sorted(pieces, key=len)
        hashes = np.zeros(len(names), dtype=np.uint64)
        at = 0
        for length in sorted({len(n) for n in names}):
            group = [n for n in names[at:] if len(n) == length]
            h = np.zeros(len(group), dtype=np.uint64)
            for c in range(length):
                h = self._extend(h, self._code_points(group, length)[:, length - 1 - c])
            hashes[at:at + len(group)] = h
            at += len(group)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.array([pieces[n] for n in names], dtype=np.int64)[order]
        self.maybe = np.zeros(1 << self._BITS, dtype=bool)
        self.maybe[self._slot(self.hashes)] = True

    def _extend(self, h: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Hash of a substring from the hash of the same without its first character."""
        return (h + points.astype(np.uint64) + np.uint64(1)) * self._STEP

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * self._STEP >> np.uint64(64 - self._BITS)).astype(np.int64)

    @staticmethod
    def _code_points(words: list[str], length: int) -> np.ndarray:
        raw = "".join(words).encode("utf-32-le", "surrogatepass")
        return np.frombuffer(raw, dtype=np.uint32).reshape(len(words), length)

    def ends(self, words: list[str]) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For every end i = 1.. the (k, word numbers, piece numbers) of the
        pieces words[n][i-k:i]; words of one length.  A character that is no
        piece itself counts as the unknown piece."""
        length = len(words[0])
        points = self._code_points(words, length)
        out = []
        for i in range(1, length + 1):
            h, found = np.zeros(len(words), dtype=np.uint64), []
            for k in range(1, min(self.longest, i) + 1):
                h = self._extend(h, points[:, i - k])
                rows = np.flatnonzero(self.maybe[self._slot(h)])
                at = np.minimum(np.searchsorted(self.hashes, h[rows]), len(self.hashes) - 1)
                hit = self.hashes[at] == h[rows]
                rows, numbers = rows[hit], self.numbers[at[hit]]
                if k == 1:
                    full = np.full(len(words), self.unknown)
                    full[rows] = numbers
                    rows, numbers = np.arange(len(words)), full
                if len(rows):
                    found.append((k, rows, numbers))
            out.append(found)
        return out

    def log_probability(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """[word, language]: log of the summed probability over all segmentations."""
        out = np.empty((len(words), table.shape[1]))
        by_length = defaultdict(list)
        for j, w in enumerate(words):
            by_length[len(w)].append(j)
        for length, group in by_length.items():
            if length > LONG_WORD:
                for j in group:
                    out[j] = self._forward_long(words[j], table)
                continue
            step = max(1, 60_000 // length)
            for at in range(0, len(group), step):
                js = group[at:at + step]
                out[js] = self._forward([words[j] for j in js], table)
        return out

    def _forward(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """The running sums are rescaled at every character, so that words of
        any length keep their precision."""
        n, langs = len(words), table.shape[1]
        recent = {0: np.ones((n, langs))}           # alpha by end, relative to ``scale``
        scale = np.zeros((n, langs))
        for i, found in enumerate(self.ends(words), 1):
            now = np.zeros((n, langs))
            for k, rows, numbers in found:
                if len(rows) == n:
                    now += recent[i - k] * table[numbers]
                else:
                    now[rows] += recent[i - k][rows] * table[numbers]
            recent[i] = now
            recent.pop(i - self.longest, None)
            if i % 8 == 0:                          # a product of 8 probabilities cannot underflow
                low = now.copy()
                for r in recent.values():
                    r /= low
                scale += np.log(low)
        return scale + np.log(recent[len(words[0])])

    def _forward_long(self, word: str, table: np.ndarray) -> np.ndarray:
        """The same for one long word (a text without white space): its pieces
        are looked up for all ends at once."""
        points, length = self._code_points([word], len(word))[0], len(word)
        h, found = np.zeros(length + 1, dtype=np.uint64), []
        for k in range(1, min(self.longest, length) + 1):
            h = self._extend(h[1:], points[:length - k + 1])        # of the substrings ending at k .. length
            rows = np.flatnonzero(self.maybe[self._slot(h)])
            at = np.minimum(np.searchsorted(self.hashes, h[rows]), len(self.hashes) - 1)
            hit = self.hashes[at] == h[rows]
            rows, numbers = rows[hit], self.numbers[at[hit]]
            if k == 1:
                full = np.full(length, self.unknown)
                full[rows] = numbers
                rows, numbers = np.arange(length), full
            found.append((rows + k, np.full(len(rows), k), numbers))
        ends, sizes, numbers = (np.concatenate(f) for f in zip(*found))
        order = np.argsort(ends, kind="stable")
        sizes, numbers = sizes[order], numbers[order]
        bounds = np.searchsorted(ends[order], np.arange(1, length + 2)).tolist()
        ring = np.zeros((self.longest, table.shape[1]))             # alpha by end, modulo the longest piece
        ring[0] = 1.0
        scale = np.zeros(table.shape[1])
        for i in range(1, length + 1):
            a, b = bounds[i - 1], bounds[i]
            now = (ring[(i - sizes[a:b]) % self.longest] * table[numbers[a:b]]).sum(axis=0)
            ring[i % self.longest] = now
            if i % 8 == 0:
                ring /= now
                scale += np.log(now)
        return scale + np.log(ring[length % self.longest])

    def expected_counts(self, words: list[str], weights: np.ndarray, column: np.ndarray,
                        into: np.ndarray) -> None:
        """Adds the expected uses of each piece (forward-backward) for words of
        one length; ``column`` holds one language's probabilities."""
        n, length, ends = len(words), len(words[0]), self.ends(words)
        alpha, beta = np.zeros((length + 1, n)), np.zeros((length + 1, n))
        scale = np.ones((length + 1, n))            # alpha[i] stands for itself times scale[1..i]
        alpha[0] = beta[length] = 1.0
        uses = []
        for i, found in enumerate(ends, 1):
            for k, rows, numbers in found:
                factor = column[numbers] / scale[i - k + 1:i, rows].prod(axis=0)
                alpha[i, rows] += alpha[i - k, rows] * factor
                uses.append((i, k, rows, numbers, factor))
            scale[i], alpha[i] = alpha[i], 1.0
        for i, k, rows, numbers, factor in reversed(uses):
            use = factor / scale[i, rows] * beta[i, rows]
            beta[i - k, rows] += use
            np.add.at(into, numbers, weights[rows] * use)


class LanguageModel:
    """Piece probabilities per language, and the scorer built on them."""

    def __init__(self, pieces_path: str, langs: list[str], probabilities: np.ndarray, priors: np.ndarray):
        self.pieces_path, self.langs, self.priors = pieces_path, langs, priors
        self.probabilities = probabilities              # [piece, language]

    def table(self) -> np.ndarray:
        n = len(self.langs)
        return np.vstack([self.probabilities, np.full((1, n), UNKNOWN)])


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _seed(word: str) -> str:
    return "▁" + word


def _segments(word: Column) -> Column:
    """A word as array of (word, head): itself, or a long one's consecutive
    parts, of which only the first begins as a word does."""
    parts = F.regexp_extract_all(word, F.lit(f"(?s).{{1,{TRAIN_WORD_CHARS}}}+"), F.lit(0))
    return F.when(F.length(word) <= TRAIN_WORD_CHARS, F.array(F.struct(word.alias("word"), F.lit(True).alias("head")))) \
        .otherwise(F.transform(parts, lambda p, i: F.struct(p.alias("word"), (i == 0).alias("head"))))


def train(docs: DataFrame, learn_from: Column, text_col: str = "text", lang_col: str = "lang",
          key_col: str = "doc_id", vocabulary: str | None = None, rows_per_lang: int = ROWS_PER_LANG,
          rounds: int = EM_ROUNDS) -> LanguageModel:
    """Piece probabilities learnt from about ``rows_per_lang`` rows of every
    language among the rows where ``learn_from`` holds.  The word counts of the
    sample are a Spark table; every EM round is one pass over it whose result
    has at most one row per language and piece."""
    path = vocabulary or default_vocabulary()
    pieces = load_pieces(path)
    usable = docs.filter(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    langs = sorted(counts)
    lattice = Lattice(pieces)
    if not langs:
        return LanguageModel(path, [], np.zeros((len(pieces), 0)), np.zeros(0))
    share = F.lit(0.0)
    number = F.lit(0)
    for i, lang in enumerate(langs):
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, rows_per_lang / counts[lang]))).otherwise(share)
        number = F.when(F.col(lang_col) == lang, F.lit(i)).otherwise(number)
    sample = usable.filter(hash_share(F.col(key_col), share, 9))
    words = saved(
        sample.select(number.cast("int").alias("lang_no"),
                      F.explode(F.split(F.trim(F.lower(text_col)), r"\s+")).alias("word"))
        .filter(F.length("word") > 0).select("lang_no", F.explode(_segments(F.col("word"))).alias("s"))
        .select("lang_no", "s.word", "s.head")
        .groupBy("lang_no", "word", "head").agg(F.count(F.lit(1)).alias("n"))
        .repartition(parallelism(docs.sparkSession), "word"), "langwords")
    uniform = np.full((len(pieces), len(langs)), 1.0 / len(pieces))
    model = LanguageModel(path, langs, uniform, np.full(len(langs), 1.0 / len(langs)))
    schema = fields(("lang_no", T.IntegerType()), ("piece", T.IntegerType()), ("used", T.DoubleType()))
    spark = docs.sparkSession
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        used = (words.mapInArrow(_expectation(shared), schema)
                .groupBy("lang_no", "piece").agg(F.sum("used").alias("used")).toPandas())
        sums = np.zeros((len(pieces), len(langs)))
        sums[used.piece.to_numpy(), used.lang_no.to_numpy()] = used.used.to_numpy()
        total = np.maximum(sums.sum(axis=0), 1e-300)
        model = LanguageModel(path, langs, (1 - UNIFORM_SHARE) * sums / total + UNIFORM_SHARE / len(pieces),
                              model.priors)
    return model


def _expectation(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lattice = Lattice(load_pieces(model.pieces_path))
        table = model.table()
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            groups = defaultdict(list)
            for lang, word, head, n in zip(*(batch.column(c).to_pylist() for c in ("lang_no", "word", "head", "n"))):
                word = _seed(word) if head else word
                groups[lang, len(word)].append((word, n))
            for (lang, _), rows in sorted(groups.items()):
                into = sums.setdefault(lang, np.zeros(len(table)))
                for at in range(0, len(rows), 4096):
                    part = rows[at:at + 4096]
                    lattice.expected_counts([w for w, _ in part],
                                            np.array([n for _, n in part], dtype=float),
                                            np.ascontiguousarray(table[:, lang]), into)
        for lang, into in sums.items():
            at = np.flatnonzero(into[:lattice.unknown])
            yield pa.RecordBatch.from_pydict({
                "lang_no": pa.array(np.full(len(at), lang, dtype=np.int32)),
                "piece": pa.array(at.astype(np.int32)), "used": pa.array(into[at])})
    return run


class TextScorer:
    """Log-probability of texts under every language, with a bounded word memory."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.lattice, self.table = Lattice(load_pieces(model.pieces_path)), model.table()
        self.known: dict[str, int] = {}
        self.values = np.empty((1024, len(model.langs)))

    def _rows_of(self, words: set[str]) -> dict[str, int]:
        """Evaluates the words not yet known; returns the rows of ``values`` of
        those beyond the memory's bound, which hold until the next call."""
        new = [w for w in words if w not in self.known]
        at = len(self.known)
        if at + len(new) > len(self.values):
            grown = np.empty((at + len(new) + 4096, self.values.shape[1]))
            grown[:at] = self.values[:at]
            self.values = grown
        if new:
            self.values[at:at + len(new)] = self.lattice.log_probability([_seed(w) for w in new], self.table)
        keep = max(0, CACHED_WORDS - at)
        self.known.update(zip(new[:keep], range(at, at + keep)))
        return dict(zip(new[keep:], range(at + keep, at + len(new))))

    def logs(self, texts: list[str]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        passing = self._rows_of(set().union(*split))
        known = self.known.get
        out = np.zeros((len(texts), len(self.model.langs)))
        for j, words in enumerate(split):
            if words:
                rows = list(map(known, words))
                if passing:
                    rows = [passing[w] if r is None else r for r, w in zip(rows, words)]
                out[j] = self.values[np.array(rows, dtype=np.int64)].sum(axis=0)
        return out


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _judge(shared, text_col: str, keep: tuple[str, ...], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = TextScorer(model) if model.langs else None
        for part, texts in text_groups(batches, text_col):
            names: list[str] = [UNDETERMINED] * len(texts)
            scores = np.zeros(len(texts))
            at = [j for j, t in enumerate(texts) if scorer and _has_letter(t)]
            if at:
                logs = scorer.logs([texts[j] for j in at]) + np.log(model.priors)
                best = logs.argmax(axis=1)
                share = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                scores[at] = share
                for j, b in zip(at, best):
                    names[j] = model.langs[b]
            columns = [part.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores)], schema=schema)
    return run


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             keep: tuple[str, ...] = ("doc_id",), name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``keep`` columns of every row, the predicted language and its posterior."""
    from pyspark.sql.pandas.types import to_arrow_schema

    given = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    out = T.StructType([*[given.schema[c] for c in keep], T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return given.mapInArrow(_judge(shared, text_col, keep, to_arrow_schema(out)), out)


HELD_OUT_OF, HELD_OUT = 4, 2


def learnable(key: str = "doc_id") -> Column:
    return F.coalesce(remainder(key, HELD_OUT_OF) != HELD_OUT, F.lit(False))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from the rows that are not held out."""
    from llm.common import load

    docs = load(spark, sf_dir, "documents")
    model = train(docs, learnable())
    return (identify(docs, model)
            .select("doc_id", F.coalesce(remainder("doc_id", HELD_OUT_OF) == HELD_OUT, F.lit(False)).alias("held_out"),
                    "lang_pred", "score"))
