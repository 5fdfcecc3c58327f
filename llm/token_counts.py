"""Token counts of whole texts by rank-synchronous array merging.

A subword model with merge ranks (byte pair encoding) is applied to a batch of
pre-tokens at once.  The symbols of all pre-tokens stand in one ragged array;
in every step each sequence merges its lowest-rank pair, all sequences at the
same time, until no pair of any sequence is a piece.  What is left are the
tokens, which are only counted.

* **Pre-tokens** are runs of blanks with what follows them.  No piece of such a
  vocabulary goes on after a blank that follows another character (checked when
  the model is loaded), so no merge crosses their borders.  They are cut again
  between characters that stand side by side in no piece.
* **Order.**  Merging one at a time would take the leftmost pair of the lowest
  rank.  A step takes all of them, from the left, up to the first whose merge
  makes a pair of the same or a lower rank, since that pair would come next.
  So a step gives what the merges one by one give.
* **Memory.**  A worker remembers the counts of at most ``CACHED_WORDS``
  pre-tokens; long texts are read in slices and long pre-tokens in parts, so a
  task needs little beside the text itself.  Only a sequence of characters that
  may all merge with their neighbours stays in one piece.

Definitions for odd input: a NULL or empty text has no bytes and no tokens;
strings that look like special tokens are ordinary text; rows are counted one by
one, repeated rows and keys (NULL, too) included; an empty table gives no rows;
columns beside the key and the text take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from llm.common import load, text_groups

LIMIT = 4096                 # tokens; longer documents are marked
CACHED_WORDS = 500_000       # pre-tokens a worker remembers
SLICE_CHARS = 1_000_000      # a text is split into pre-tokens in slices of about this length
PART_CHARS = 500_000         # symbols merged at once
BLANK = "▁"             # how the vocabulary writes a blank
_NEVER = np.iinfo(np.int32).max
_WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
_SAFE = re.compile(f"[^{BLANK}]{BLANK}")


class Merges:
    """The pieces of a sentencepiece model as sorted arrays of mergeable pairs."""

    def __init__(self, model: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        if not any(sp.is_byte(i) for i in range(size)) or any(sp.is_unused(i) for i in range(size)):
            raise ValueError("the model must fall back to bytes and use all its pieces")
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        pieces = {sp.id_to_piece(i): i for i in plain}
        if any(_SAFE.search(p) for p in pieces):
            raise ValueError("a piece goes on after a blank")
        score = {p: sp.get_score(i) for p, i in pieces.items()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        symbols = dict(pieces)
        for c in sorted(set().union(*pieces)):
            symbols.setdefault(c, size + len(symbols) - len(pieces))
        self.width = size + len(symbols) - len(pieces)
        # A character that is no piece of its own is written as its bytes.
        self.emits = np.ones(self.width, dtype=np.int64)
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
                self.emits[i] = 1 if c in pieces else len(c.encode())
        pairs = {}
        beside = set()
        for p, i in pieces.items():
            beside.update(ord(a) << 21 | ord(b) for a, b in zip(p, p[1:]))
            for at in range(1, len(p)):
                left, right = symbols.get(p[:at]), symbols.get(p[at:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (rank[score[p]], i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int32)
        self.beside = np.array(sorted(beside), dtype=np.int64)
        self.blank_run = self._blank_run(pieces, score)
        self.known: dict[str, int] = {}

    @staticmethod
    def _blank_run(pieces: dict[str, int], score: dict[str, float]) -> int:
        """The length of the longest piece of blanks, when a long run of blanks
        is cut into such pieces from the left: blanks alone share the lowest
        score, so they merge last and from the left, and the longest piece is
        done before a blank behind it is touched.  0 when that is not so."""
        runs = {len(p) for p in pieces if len(p) > 1 and set(p) == {BLANK}}
        last = min(score.values())
        if not runs or any((score[p] == last) != (set(p) == {BLANK}) or (BLANK * 2 in p and set(p) != {BLANK})
                           for p in pieces if len(p) > 1):
            return 0
        longest, now = max(runs), [1] * 3 * max(runs)
        while now[0] < longest:
            i = next(i for i, (a, b) in enumerate(zip(now, now[1:])) if a + b in runs)
            now[i:i + 2] = [now[i] + now[i + 1]]
        return longest if set(now[1:]) == {1} else 0

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``_NEVER`` if none) and result of merging ``left`` with ``right``."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NEVER), self.made[at]

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        out = np.zeros(len(words), dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        if not len(points):
            return out
        head = np.ones(len(points), dtype=bool)
        both = points[:-1] << 21 | points[1:]
        at = np.minimum(np.searchsorted(self.beside, both), len(self.beside) - 1)
        head[1:] = (self.beside[at] != both) | (owner[1:] != owner[:-1])
        sym = self.symbol_of[points]
        other = sym < 0
        if other.any():        # characters of no piece: one token a byte
            p = points[other]
            np.add.at(out, owner[other], 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF))
            sym, owner, head = sym[~other], owner[~other], head[~other]
        self._merge(sym, owner, head, out)
        return out

    def _merge(self, sym: np.ndarray, owner: np.ndarray, head: np.ndarray, out: np.ndarray) -> None:
        """Merges all sequences to the end, adding the tokens left to ``out``."""
        rank = np.full(len(sym), _NEVER, dtype=np.int32)
        made = np.zeros(len(sym), dtype=np.int32)
        rank[:-1], made[:-1] = self._pairs(sym[:-1], sym[1:])
        rank[:-1][head[1:]] = _NEVER
        while len(sym):
            starts = np.flatnonzero(head)
            lengths = np.diff(starts, append=len(sym))
            low = np.minimum.reduceat(rank, starts)
            done = low == _NEVER
            if done.any():
                gone = np.repeat(done, lengths)
                np.add.at(out, owner[gone], self.emits[sym[gone]])
                sym, owner, head, rank, made = (a[~gone] for a in (sym, owner, head, rank, made))
                low, lengths = low[~done], lengths[~done]
                if not len(sym):
                    return
            hits = np.flatnonzero(rank == np.repeat(low, lengths))
            # of hits side by side every second is taken, from the left
            fresh = np.diff(hits, prepend=-2) != 1
            hits = hits[(hits - hits[fresh][np.cumsum(fresh) - 1]) % 2 == 0]
            hits = hits[self._in_order(hits, sym, head, rank, made)]
            sym[hits] = made[hits]
            stays = np.ones(len(sym), dtype=bool)
            stays[hits + 1] = False
            sym, owner, head, rank, made = (a[stays] for a in (sym, owner, head, rank, made))
            at = hits - np.arange(len(hits))
            changed = np.unique(np.concatenate([at, at[~head[at]] - 1]))
            last = (changed + 1 == len(sym)) | head[np.minimum(changed + 1, len(sym) - 1)]
            rank[changed[last]] = _NEVER
            changed = changed[~last]
            rank[changed], made[changed] = self._pairs(sym[changed], sym[changed + 1])

    def _in_order(self, hits: np.ndarray, sym: np.ndarray, head: np.ndarray, rank: np.ndarray, made: np.ndarray) -> np.ndarray:
        """Which of the hits may be merged in this step: in each sequence those
        up to the first that makes a pair of no higher rank."""
        new, before, after = made[hits], hits - 1, hits + 2
        left = sym[np.maximum(before, 0)]
        joined = np.flatnonzero(np.diff(hits) == 2) + 1      # the symbol before is made in this step, too
        left[joined] = new[joined - 1]
        worst = np.where(head[hits], _NEVER, self._pairs(left, new)[0])
        inside = after < len(sym)
        after = np.minimum(after, len(sym) - 1)
        worst = np.minimum(worst, np.where(inside & ~head[after], self._pairs(new, sym[after])[0], _NEVER))
        early = worst <= rank[hits]
        if not early.any():
            return np.ones(len(hits), dtype=bool)
        sequence = np.cumsum(head)[hits]
        found = np.flatnonzero(early)
        of, first = np.unique(sequence[found], return_index=True)
        limit = np.full(sequence[-1] + 1, len(hits))
        limit[of] = found[first]
        return np.arange(len(hits)) <= limit[sequence]

    def _parts(self, word: str) -> Iterator[str]:
        """A long pre-token in parts, cut between characters of no common piece."""
        start = 0
        while len(word) - start > PART_CHARS:
            cut = next((i for i in range(start + PART_CHARS, len(word)) if not self._joined(word[i - 1], word[i])), None)
            if cut is None:
                break
            yield word[start:cut]
            start = cut
        yield word[start:]

    def _joined(self, a: str, b: str) -> bool:
        key = ord(a) << 21 | ord(b)
        at = np.searchsorted(self.beside, key)
        return bool(at < len(self.beside) and self.beside[at] == key)

    def _learn(self, words: list[str]) -> None:
        """Counts the pre-tokens, about ``PART_CHARS`` symbols at a time."""
        batch, places, chars, extra = [], [], 0, {}
        run = self.blank_run

        def flush() -> None:
            for word, n in zip(places, self.counts(batch).tolist()):
                self.known[word] = self.known.get(word, 0) + n
            batch.clear()
            places.clear()

        for word in words:
            short = word
            if run and word.startswith(BLANK * (2 * run + 2)):
                blanks = len(word) - len(word.lstrip(BLANK))
                whole = (blanks - run - 1) // run          # pieces of blanks only, cut off in front
                short, extra[word] = word[whole * run:], whole
            for part in self._parts(short) if len(short) > PART_CHARS else (short,):
                batch.append(part)
                places.append(word)
                chars += len(part)
                if chars >= PART_CHARS:
                    flush()
                    chars = 0
        flush()
        for word, n in extra.items():
            self.known[word] += n

    def __call__(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text."""
        out, held, words = [], [], set()
        for n, text in enumerate(texts):
            out.append(0)
            for part in slices(self.processor.normalize(text) if text else ""):
                found = _WORDS.findall(part)
                if len(part) > SLICE_CHARS // 2:           # a long slice is counted at once
                    out[n] += self._total([found], set(found))[0]
                else:
                    held.append((n, found))
                    words.update(found)
        for (n, _), total in zip(held, self._total([f for _, f in held], words)):
            out[n] += total
        return out

    def _total(self, lists: list[list[str]], words: set[str]) -> list[int]:
        new = words.difference(self.known)
        if new and len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = words
        if new:
            self._learn(list(new))
        return [sum(map(self.known.__getitem__, found)) for found in lists]


def slices(text: str, size: int | None = None) -> Iterator[str]:
    """A normalised text in slices that begin at a blank after another character."""
    size, start = size or SLICE_CHARS, 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size - 1)
        if cut is None:
            break
        yield text[start:cut.start() + 1]
        start = cut.start() + 1
    if start < len(text):
        yield text[start:]


_MERGES: dict[str, Merges] = {}


def merges(model: str | None = None) -> Merges:
    """One per worker process: its memory serves all the tasks it runs."""
    import public_tokenizers

    model = model or public_tokenizers.path("piece_bpe_32k.model")
    if model not in _MERGES:
        _MERGES[model] = Merges(model)
    return _MERGES[model]


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """Per row: key, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``."""
    out = T.StructType([docs.schema[key], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = merges(model)
        for part, texts in text_groups(batches, text):
            n_bytes = pa.compute.fill_null(pa.compute.binary_length(part.column(text)), 0).cast(pa.int64())
            n_tokens = pa.array(count(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(key), n_bytes, n_tokens, pa.compute.greater(n_tokens, limit)], names=out.names)

    return docs.select(key, text).mapInArrow(run, out)


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public vocabulary of 32,000 pieces."""
    return count_tokens(load(spark, sf_dir, "documents"))
