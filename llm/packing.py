"""Best-fit packing of tokenised documents into sequences.

Documents are tokenised in one pass and cut into pieces of at most ``room``
tokens.  Best-fit decreasing is then planned on the histogram of piece lengths
(at most ``room`` counts, whatever the number of documents): all pieces of one
length are placed at once into all bins of the smallest free space that holds
them.  The plan says, for every length, which ranks go to which sequences at
which offset; pieces get a rank within their length from counts per task, and
join the plan on length and rank.

Definitions for odd input: a NULL text is empty; an empty text still has its
end token, so every row gives at least one piece; repeated rows (and keys) are
packed each on their own; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import saved, text_groups

ROOM = 1024
END_ID = 2
CACHED_WORDS = 250_000       # odd words a worker remembers; others are encoded again
LONG_WORD = 64               # characters; longer words are not remembered
GATHERED_WORDS = 250_000     # words whose ids are put in place at once
GROUP_CHARS = 4_000_000      # of the texts encoded in one call: the larger, the fewer words are encoded again
SPECIAL = "<|endoftext|>"       # the vocabulary's one special token
# A blank next to other white space on both sides (or at the end) is no safe place to split.
_UNSAFE = re.compile(r"\s (?:\s|\Z)")
# Characters that the two libraries' patterns might class differently.
_RARE = re.compile("[\u0250-\U0010ffff]")
# Words that are encoded by themselves (for Arrow): empty ones, those that begin with white space, those with rare characters.
_ODD = r"^$|^[\t-\r\x1c-\x20\x{85}\x{a0}]|[\x{250}-\x{10ffff}]"


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Word splitting never crosses a blank that follows a non-blank, so the texts
    of a call are cut at their blanks, and each different word is encoded once a
    call.  ``vocabulary`` is a ``tokenizers`` file; ``ranks`` the same vocabulary
    as merge ranks, whose faster library takes all words of familiar characters
    in one text; their ids are told apart by the byte lengths of the tokens.
    Arrow and numpy split the texts and put the ids in place, so that no Python
    step is taken per word; only words with rare characters or white space in
    front are taken one by one, and remembered.
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                      special_tokens={})
        self.token_bytes = np.zeros(max(table.values()) + 1, dtype=np.int64)
        self.token_bytes[list(table.values())] = list(map(len, table))
        self.full = None
        self.known: dict[str, bytes] = {}

    def _encode_full(self, text: str) -> bytes:
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.vocabulary)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode(self, text: str) -> bytes:
        if _RARE.search(text):
            return self._encode_full(text)
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()

    def _encode_odd(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a blank before it, word by word; short ones are remembered."""
        out = []
        for word in words:
            ids = self.known.get(word)
            if ids is None:
                ids = self._encode(" " + word)
                if len(word) <= LONG_WORD and len(self.known) < CACHED_WORDS:
                    self.known[word] = ids
            out.append(ids)
        return out

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the words with a blank before each, and every word's number of ids."""
        odd = pa.compute.match_substring_regex(words, _ODD)
        plain, rest = words.filter(pa.compute.invert(odd)), words.filter(odd).to_pylist()
        ids, sizes = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        if len(plain):
            text = pa.compute.binary_join(pa.ListArray.from_arrays([0, len(plain)], plain), pa.scalar(" ", plain.type))[0].as_py()
            ids = self.fast.encode_to_numpy(" " + text).astype("<u4", copy=False)
            ends = np.cumsum(pa.compute.binary_length(plain).to_numpy() + 1)
            sizes = np.diff(np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1, prepend=0)
        if rest:
            found = self._encode_odd(rest)
            odd = odd.to_numpy(zero_copy_only=False)
            own = np.empty(len(words), dtype=np.int64)
            own[~odd], own[odd] = sizes, [len(f) // 4 for f in found]
            stops = np.cumsum(own)
            mixed = np.empty(stops[-1], dtype="<u4")
            is_odd = np.repeat(odd, own)
            mixed[~is_odd], mixed[is_odd] = ids, np.frombuffer(b"".join(found), dtype="<u4")
            ids, sizes = mixed, own
        return ids, sizes

    def _encode_split(self, texts: list[str]) -> list[bytes]:
        """Texts whose every blank is a place to split: each of their words is encoded once."""
        lists = pa.compute.split_pattern(pa.array(texts, pa.large_string()), " ")
        spelled = lists.flatten().dictionary_encode()
        ids, sizes = self._encode_words(spelled.dictionary)
        # a text's first word has no blank before it: an entry of its own after those of the words
        firsts = [text[:text.index(" ")] if " " in text else text for text in texts]
        heads = [self._encode(word) if word else b"" for word in firsts]
        ids = np.concatenate([ids, np.frombuffer(b"".join(heads), dtype="<u4")])
        sizes = np.concatenate([sizes, np.array([len(h) // 4 for h in heads], dtype=np.int64)])
        starts = np.cumsum(sizes) - sizes
        cuts = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())])
        word = spelled.indices.to_numpy().copy()
        word[cuts[:-1]] = len(spelled.dictionary) + np.arange(len(texts))
        ends = np.concatenate([[0], np.cumsum(sizes[word])])
        out = np.empty(ends[-1], dtype="<u4")
        for at in range(0, len(word), GATHERED_WORDS):
            part, first = word[at:at + GATHERED_WORDS], ends[at]
            last = ends[at + len(part)]
            shift = starts[part] - (ends[at:at + len(part)] - first)
            out[first:last] = ids[np.arange(last - first) + np.repeat(shift, sizes[part])]
        places = ends[cuts].tolist()
        return [out[a:b].tobytes() for a, b in zip(places, places[1:])]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out = [b""] * len(texts)
        split = []
        for j, text in enumerate(texts):
            if not text:
                continue
            if SPECIAL in text:
                out[j] = self._encode_full(text)
            elif _UNSAFE.search(text):
                out[j] = self._encode(text)
            else:
                split.append(j)
        if split:
            for j, ids in zip(split, self._encode_split([texts[j] for j in split])):
                out[j] = ids
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*files: str | None) -> Encoder:
    """One encoder per worker process: its memory serves all the tasks it runs."""
    if files not in _ENCODERS:
        _ENCODERS[files] = Encoder(*files)
    return _ENCODERS[files]


def pieces_of(ids: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than ``room``."""
    if ids <= room:
        return [(0, ids)]
    head = ids % room or room
    return [(0, head), *((at, room) for at in range(head, ids, room))]


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", room: int = ROOM,
                 vocabulary: str | None = None, ranks: str | None = None, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """One row per piece, with its task and its place among the task's pieces of that length."""
    ids_field = [T.StructField("ids", T.BinaryType())] if with_ids else []
    out = T.StructType([docs.schema[key], *[T.StructField(n, t) for n, t in (
        ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
        ("ids_crc32", T.LongType()), ("task", T.IntegerType()), ("nth", T.LongType()))], *ids_field])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary, ranks), TaskContext.get().partitionId()
        seen = np.zeros(room + 1, dtype=np.int64)
        for part, texts in text_groups(batches, text, GROUP_CHARS):
            rows, source = [], []
            for j, ids in enumerate(encode(texts)):
                ids += end
                for n, (start, length) in enumerate(pieces_of(len(ids) // 4, room)):
                    own = ids[4 * start:4 * (start + length)]
                    rows.append((n, start, length, zlib.crc32(own), task, int(seen[length]),
                                 *([own] if with_ids else [])))
                    seen[length] += 1
                    source.append(j)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [part.column(key).take(pa.array(source, pa.int64())),
                 *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names=out.names)

    return docs.select(key, text).mapInArrow(run, out)


def best_fit(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on counts per length.  Rows (length, first rank, last
    rank, pieces a bin, first sequence, offset there): of each length, ranks in
    order fill consecutive sequences."""
    free: list[list[tuple[int, int]]] = [[] for _ in range(room + 1)]   # bins (first, number) by free space
    plan, bins = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            space = next((s for s in range(length, room + 1) if free[s]), None)
            if space is None:
                first, number, space = bins, -(-left // (room // length)), room
                bins += number
            else:
                first, number = free[space].pop()
            each = space // length
            used = min(number, left // each)
            if used:
                plan.append((length, rank, rank + used * each - 1, each, first, room - space))
                free[space - each * length].append((first, used))
                rank, left = rank + used * each, left - used * each
            if used < number:
                if left and left < each:        # the last bin takes the rest
                    plan.append((length, rank, rank + left - 1, left, first + used, room - space))
                    free[space - left * length].append((first + used, 1))
                    rank, left, used = rank + left, 0, used + 1
                if used < number:
                    free[space].append((first + used, number - used))
    return plan


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", room: int = ROOM,
         vocabulary: str | None = None, ranks: str | None = None, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``; ``with_ids`` keeps each
    piece's ids (little-endian unsigned 32-bit) for writing the sequences."""
    spark: SparkSession = docs.sparkSession
    pieces = saved(token_pieces(docs, key, text, room, vocabulary, ranks, end_id, with_ids), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")
                             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("_before"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}   # at most ``room`` rows
    plan = spark.createDataFrame(
        best_fit(histogram, room),
        "_length long, _from long, _to long, _each long, _sequence long, _offset long")
    ranked = pieces.join(offsets, ["length", "task"]).withColumn("_rank", F.col("nth") + F.col("_before"))
    within = F.col("_rank") - F.col("_from")
    return (ranked.join(plan, (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_from"), F.col("_to")))
            .select(key, "piece", "start", "length", "ids_crc32",
                    (F.col("_sequence") + F.floor(within / F.col("_each"))).alias("sequence_id"),
                    (F.col("_offset") + within % F.col("_each") * F.col("length")).alias("offset"),
                    *(["ids"] if with_ids else [])))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    from llm.common import load

    return pack(load(spark, sf_dir, "documents"))
