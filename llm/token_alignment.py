"""Alignment of two tokenizers' tokens by the bytes they cover.

Both tokenizers write a text's bytes (a blank in front) as tokens.  A token is a
row of a token-byte incidence matrix: A with the tokens of the first tokenizer,
B of the second.  The sparse product A·Bᵀ, row by row (Gustavson), gives the
pairs of tokens that share bytes and how many; of these, pairs whose ranges end
at the same byte are the *end* links.  The ends they share cut both token
sequences into groups, the smallest runs that cover the same bytes; the product
of the token-group incidences gives the pairs of tokens within a group.

* **Batches.**  Texts are cut into slices at blanks between two characters that
  are no white space, where tokens of both end; slices of many texts stand in
  one pair of matrices.  Memory follows the slice, not the text, unless a text
  has no such blank.
* **Counts.**  Each row keeps its distinct linked id pairs and how often it has
  them.  Their corpus-wide sums are one ``groupBy`` over (id, id).  Of two tokens
  that end together the shorter one's bytes end the longer one's, so the pairs
  are limited by the two vocabularies (``pair_bound``, about 0.3 million here)
  whatever the number of rows: that table alone goes back to the tasks.

Definitions for odd input: a NULL or empty text, and one whose tokens do not
give back its bytes (a text with U+2581, which the second vocabulary writes for
a blank), has no tokens: all numbers are zero and its digest is empty.  Strings
that look like special tokens are ordinary text.  Rows count one by one,
repeated rows and keys (NULL, too) included; an empty table gives no rows;
columns beside the key and the text take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import load, saved, text_groups
from llm.packing import Encoder

SLICE_CHARS = 200_000        # a text is aligned in slices of about this length
BATCH_CHARS = 400_000        # slices aligned at once
LINKS = ("end", "overlap", "group")
_ID_BITS = 20                # an id of either vocabulary
_CUT = re.compile(r"(?<=\S) (?=\S)")
_COMMA, _BAR, _SEMICOLON, _NOTHING = range(4)


class Csr:
    """A sparse matrix by rows: row i holds ``values`` at the columns
    ``columns[starts[i]:starts[i + 1]]``."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.starts, self.columns, self.values, self.width = starts, columns, values, width

    @classmethod
    def incidence(cls, lengths: np.ndarray) -> Csr:
        """Rows that follow one another: row i covers the next ``lengths[i]`` columns."""
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return cls(starts, np.arange(starts[-1]), np.ones(starts[-1], dtype=np.int64), int(starts[-1]))

    @classmethod
    def members(cls, column: np.ndarray, width: int) -> Csr:
        """Rows with a single one, at ``column[i]``."""
        return cls(np.arange(len(column) + 1), column, np.ones(len(column), dtype=np.int64), width)

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def transposed(self) -> Csr:
        rows = self.rows()
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, rows[order], self.values[order], len(self.starts) - 1)

    def times(self, other: Csr) -> Csr:
        """The product, row by row: a row is the sum of the rows of ``other`` at
        its columns, each times its value."""
        counts = np.diff(other.starts)[self.columns]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(other.starts[self.columns] - (ends - counts), counts)
        key = np.repeat(self.rows(), counts) * other.width + other.columns[at]
        value = np.repeat(self.values, counts) * other.values[at]
        if total and (np.diff(key) < 0).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        rows, columns = np.divmod(key[first], max(1, other.width))
        summed = np.add.reduceat(value, first) if len(first) else value
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(self.starts) - 1))])
        return Csr(starts, columns, summed, other.width)


class PlainEncoder(Encoder):
    """The byte-level vocabulary, special strings read as ordinary text."""

    def _encode_full(self, text: str) -> bytes:
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.vocabulary)
            self.full.encode_special_tokens = True
        return super()._encode_full(text)


class TokenBytes:
    """The bytes of a vocabulary's tokens, by id."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        text = [str(i) for i in range(len(tokens))]
        self.texts = np.array([t + end for end in (",", "|", ";", "") for t in text], dtype=object)

    def written(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - lengths), lengths)]

    def text(self, ids: np.ndarray, ending: np.ndarray) -> np.ndarray:
        return self.texts[ending * len(self.lengths) + ids]


def piece_bytes(processor) -> list[bytes]:
    """The bytes of a sentencepiece model's pieces."""
    return [bytes([int(p[3:5], 16)]) if processor.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, processor.id_to_piece(i)) for i in range(processor.get_piece_size()))]


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None, model: str | None = None):
        import public_tokenizers
        import sentencepiece

        self.first = PlainEncoder(vocabulary, ranks)
        self.second = sentencepiece.SentencePieceProcessor(model_file=model or public_tokenizers.path("piece_bpe_32k.model"))
        own = self.first.fast
        self.a = TokenBytes([own.decode_single_token_bytes(i) for i in range(own.n_vocab)])
        self.b = TokenBytes(piece_bytes(self.second))

    def pair_bound(self) -> int:
        """How many id pairs can end together: one's bytes end the other's."""
        def endings(token: bytes, known: Counter) -> int:
            return sum(known[token[i:]] for i in range(len(token)))

        a, b = ([own.flat[s:s + n].tobytes() for s, n in zip(own.starts.tolist(), own.lengths.tolist())] for own in (self.a, self.b))
        in_a, in_b = Counter(a), Counter(b)
        return sum(endings(t, in_b) for t in a) + sum(endings(t, in_a) for t in b)

    def units(self, parts: list[str], links: str) -> list[tuple | None]:
        """Per slice (a blank in front): tokens of either kind, groups, links,
        the groups as text, linked id pairs and how often each; None where the
        tokens are not the slice's bytes."""
        a_ids = [np.frombuffer(raw, dtype="<u4").astype(np.int64) for raw in self.first(parts)]
        b_ids = [np.array(ids, dtype=np.int64) for ids in self.second.encode([p[1:] for p in parts], num_threads=1)]
        good = []
        for part, own, other in zip(parts, a_ids, b_ids):
            raw = np.frombuffer(part.encode(), dtype=np.uint8)
            good.append(np.array_equal(self.a.written(own), raw) and np.array_equal(self.b.written(other), raw))
        out: list[tuple | None] = [None] * len(parts)
        kept = [n for n, fits in enumerate(good) if fits]
        if kept:
            for n, found in zip(kept, self._align([a_ids[n] for n in kept], [b_ids[n] for n in kept], links)):
                out[n] = found
        return out

    def _align(self, a_parts: list[np.ndarray], b_parts: list[np.ndarray], links: str) -> Iterator[tuple]:
        a, b = np.concatenate(a_parts), np.concatenate(b_parts)
        a_sizes, b_sizes = (np.array([len(p) for p in parts]) for parts in (a_parts, b_parts))
        by_byte_a, by_byte_b = Csr.incidence(self.a.lengths[a]), Csr.incidence(self.b.lengths[b])
        overlap = by_byte_a.times(by_byte_b.transposed())
        left, right = overlap.rows(), overlap.columns
        ends = by_byte_a.starts[left + 1] == by_byte_b.starts[right + 1]
        a_last, b_last = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        a_last[left[ends]] = True
        b_last[right[ends]] = True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        if links == "end":
            left, right = left[ends], right[ends]
        elif links == "group":
            number = int(a_last.sum())
            shared = Csr.members(a_group, number).times(Csr.members(b_group, number).transposed())
            left, right = shared.rows(), shared.columns

        unit = np.repeat(np.arange(len(a_sizes)), a_sizes)
        pair, times = np.unique(unit[left] << 2 * _ID_BITS | a[left] << _ID_BITS | b[right], return_counts=True)
        mask = (1 << _ID_BITS) - 1
        pair_unit = pair >> 2 * _ID_BITS
        pair_cuts = np.searchsorted(pair_unit, np.arange(1, len(a_sizes)))
        pairs = zip(np.split(pair >> _ID_BITS & mask, pair_cuts), np.split(pair & mask, pair_cuts), np.split(times, pair_cuts))

        # tokens of A, then those of B, group by group
        b_unit = np.repeat(np.arange(len(b_sizes)), b_sizes)
        groups = np.bincount(unit[a_last], minlength=len(a_sizes))
        final_a = np.where(a_last, _BAR, _COMMA)
        final_b = np.where(b_last, _SEMICOLON, _COMMA)
        final_b[np.cumsum(b_sizes) - 1] = _NOTHING
        words = np.empty(len(a) + len(b), dtype=object)
        words[np.arange(len(a)) + np.searchsorted(b_group, a_group, side="left")] = self.a.text(a, final_a)
        words[np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")] = self.b.text(b, final_b)
        words = words.tolist()
        stops = np.cumsum(a_sizes + b_sizes).tolist()
        n_links = np.bincount(unit[left], minlength=len(a_sizes)).tolist()
        start = 0
        for n_a, n_b, n_groups, n, stop, found in zip(a_sizes.tolist(), b_sizes.tolist(), groups.tolist(), n_links, stops, pairs):
            yield n_a, n_b, n_groups, n, "".join(words[start:stop]), found
            start = stop


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(*files: str | None) -> Aligner:
    """One per worker process."""
    if files not in _ALIGNERS:
        _ALIGNERS[files] = Aligner(*files)
    return _ALIGNERS[files]


def slices(text: str, size: int | None = None) -> Iterator[str]:
    """The text with a blank in front, in slices that begin at a blank between
    two characters that are no white space."""
    size, text, start = size or SLICE_CHARS, " " + text, 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


class _Row:
    """What is known of one text while its slices come in."""

    def __init__(self, with_groups: bool):
        self.numbers, self.digest = [0, 0, 0, 0], None
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bad, self.texts = False, [] if with_groups else None

    def add(self, unit: tuple | None) -> None:
        if unit is None:
            self.bad = True
            self.pairs.clear()
        if self.bad:
            return
        *numbers, groups, pairs = unit
        self.numbers = [x + y for x, y in zip(self.numbers, numbers)]
        if self.digest is None:
            self.digest = hashlib.sha256()
        else:
            self.digest.update(b";")
        self.digest.update(groups.encode())
        if self.texts is not None:
            self.texts.append(groups)
        self.pairs.append(pairs)
        if len(self.pairs) >= 64:
            self.pairs = [self.linked()]

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0]
        if not self.pairs:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        a, b, times = (np.concatenate(c) for c in zip(*self.pairs))
        key, place = np.unique(a << _ID_BITS | b, return_inverse=True)
        total = np.zeros(len(key), dtype=np.int64)
        np.add.at(total, place, times)
        return key >> _ID_BITS, key & ((1 << _ID_BITS) - 1), total

    def result(self) -> tuple:
        none = self.bad or self.digest is None
        return (*([0] * 4 if none else self.numbers), "" if none else self.digest.hexdigest(), self.linked(),
                None if self.texts is None else "" if none else ";".join(self.texts))


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", links: str = "end", with_groups: bool = False,
          vocabulary: str | None = None, ranks: str | None = None, model: str | None = None) -> DataFrame:
    """Per row: key, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``groups_sha256``, and
    the distinct linked pairs as ``a``, ``b`` (ids) and ``times``; ``with_groups`` adds the groups
    as text (``a1,a2|b1;a3|b2,b3``).  ``links``: pairs that ``end`` together, ``overlap`` or
    share a ``group``."""
    if links not in LINKS:
        raise ValueError(f"links: one of {LINKS}")
    many = T.ArrayType(T.IntegerType())
    out = T.StructType([docs.schema[key], *[T.StructField(n, t) for n, t in (
        *((n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", T.StringType()),
        ("a", many), ("b", many), ("times", many), *((("groups", T.StringType()),) if with_groups else ()))]])

    def ragged(lists: list[np.ndarray]) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(vocabulary, ranks, model)
        for part, texts in text_groups(batches, text):
            rows = [_Row(with_groups) for _ in texts]
            owners, held, chars = [], [], 0
            for n, t in enumerate(texts):
                for piece in slices(t) if t else ():
                    owners.append(n)
                    held.append(piece)
                    chars += len(piece)
                    if chars >= BATCH_CHARS:
                        for i, unit in zip(owners, tool.units(held, links)):
                            rows[i].add(unit)
                        owners, held, chars = [], [], 0
            for i, unit in zip(owners, tool.units(held, links) if held else ()):
                rows[i].add(unit)
            *numbers, digests, pairs, groups = zip(*[r.result() for r in rows])
            columns = [part.column(key), *[pa.array(c, pa.int64()) for c in numbers], pa.array(digests, pa.string()),
                       *[ragged(list(c)) for c in zip(*pairs)]]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(groups, pa.string())] if with_groups else []), names=out.names)

    return docs.select(key, text).mapInArrow(run, out)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Corpus-wide: ``a``, ``b``, ``count`` (links of the pair) and ``best`` (no other
    ``a`` is linked with the ``b`` more often)."""
    counts = (aligned.select(F.explode(F.arrays_zip("a", "b", "times")).alias("_l"))
              .groupBy(F.col("_l.a").alias("a"), F.col("_l.b").alias("b")).agg(F.sum("_l.times").alias("count")))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def scored(aligned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows aligned by *end* links with ``n_best`` (links whose count is their
    second token's highest) and ``count_sum`` (over the links).  The table of
    counts has at most ``Aligner.pair_bound`` rows; it is sent to all tasks."""
    table = saved(pair_counts(aligned), "pair-counts").toArrow()
    known = table["a"].to_numpy().astype(np.int64) << _ID_BITS | table["b"].to_numpy()
    order = np.argsort(known)
    known, count = known[order], table["count"].to_numpy()[order]
    best = table["best"].to_numpy(zero_copy_only=False)[order]
    names = ["n_a", "n_b", "n_groups", "n_links"]
    out = T.StructType([aligned.schema[key], *[T.StructField(n, T.LongType()) for n in (*names, "n_best", "count_sum")],
                        aligned.schema["groups_sha256"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("a", "b", "times"))
            sizes = pa.compute.list_value_length(batch.column("a")).to_numpy()
            stops = np.concatenate([[0], np.cumsum(sizes)])
            at = np.searchsorted(known, a << _ID_BITS | b)
            sums = []
            for value in (best[at] * times if len(at) else times, count[at] * times if len(at) else times):
                run_sum = np.concatenate([[0], np.cumsum(value)])
                sums.append(pa.array(run_sum[stops[1:]] - run_sum[stops[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(key), *[batch.column(n) for n in names], *sums,
                                              batch.column("groups_sha256")], names=out.names)

    return aligned.select(key, *names, "groups_sha256", "a", "b", "times").mapInArrow(run, out)


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """Both public vocabularies' tokens of all documents aligned, with corpus-wide counts."""
    return scored(saved(align(load(spark, sf_dir, "documents")), "aligned"))
