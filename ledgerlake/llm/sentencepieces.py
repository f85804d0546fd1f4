"""SentencePiece encoding as a relational lattice, and decoding.

Pieces do not reach from one word into the next, so distinct words are encoded once: the substrings of bounded length
are exploded and joined to the piece table, the matching ones, grouped by word, are the edges of its lattice, and a
higher-order ``aggregate`` folds them. For a unigram model the fold is Viterbi's: the best path to each end. For a
byte-pair model scores are merge ranks and the best-scoring path is *not* the encoding; there the fold takes the edges
in merge order and joins the two symbols that an edge spans, as the model was trained to.

The commonest words, a table of bounded size, are then looked up in the task that holds a text. Others are encoded by
the same lattice there (``rare="task"``), or relationally as well and brought by joins (``rare="join"``), which moves
every text and several times its size in words; the README has figures. Words of more than 61 characters, such as text
without blanks, are encoded in the task that holds them, in nearly linear time: their lattice does not fit one row.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import commonest, land, materialised, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
KNOWN_WORDS = 1 << 19
LONGEST_WORD = 61  # bounds of symbols are the bits of a number


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores by id; ids of bytes; whether scores are merge ranks; ids of the runs of blanks."""

    pieces: tuple[tuple[str, float, int], ...]
    byte_ids: tuple[int, ...]
    unknown: int
    ranked: bool

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    @functools.cached_property
    def runs(self) -> dict[int, int]:
        """Pieces of several blanks by length, where they rank below all other merges (else none: they are ordinary)."""
        blank = {len(p): i for p, s, i in self.pieces if len(p) > 1 and set(p) == {SPACE}}
        low = max((s for p, s, i in self.pieces if i in blank.values()), default=0.0)
        return blank if self.ranked and all(s > low for p, s, i in self.pieces if len(p) > 1 and i not in blank.values()) else {}

    @functools.cached_property
    def repeats(self) -> bool:
        """Whether a run of blanks is whole runs of the longest piece, then what is left."""
        long = max(self.runs)
        return all(self.run(n) == [self.runs[long]] * (n // long) + self.run(n % long) for n in range(4 * long))

    def run(self, n: int) -> list[int]:
        """The pieces of ``n`` blanks on their own: the leftmost pair that makes a piece is joined, again and again."""
        long = max(self.runs, default=0)
        if long and n >= 4 * long and self.repeats:
            return [self.runs[long]] * (n // long) + self.run(n % long)
        one = next((i for p, _, i in self.pieces if p == SPACE), self.unknown)
        parts = [1] * n
        while (at := next((i for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.runs), None)) is not None:
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.runs.get(k, one) for k in parts]


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file. Only models that keep words apart and texts as they are can be used."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    if not n.add_dummy_prefix or n.remove_extra_whitespaces or n.precompiled_charsmap or not n.escape_whitespaces:
        raise ValueError("the model normalises texts")
    normal = tuple((p.piece, p.score, i) for i, p in enumerate(m.pieces) if p.type == 1)
    if any(SPACE in p.lstrip(SPACE) for p, _, _ in normal):
        raise ValueError("the model has pieces across words")
    by_byte = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
    unknown = next(i for i, p in enumerate(m.pieces) if p.type == 2)
    return Vocabulary(normal, tuple(by_byte.get(b, unknown) for b in range(256)), unknown, m.trainer_spec.model_type == 2)


def _ints(values: list[int]) -> str:
    return f"array({','.join(map(str, values))})" if values else "cast(array() as array<int>)"


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Distinct words, with ``edges``: each has rank, begin s, end e, and ids; a character without a piece has one of its bytes.

    ``words`` are partitioned by word, so grouping the edges needs no further shuffle.
    """
    keys = words.columns
    spark = words.sparkSession
    own = sorted((-s, i, p) for p, s, i in vocabulary.pieces if not (len(p) > 1 and i in vocabulary.runs.values()))
    pieces = spark.createDataFrame([(p, k, r, i) for k, (r, i, p) in enumerate(own)], "_piece string, _order int, _rank double, _id int")
    spans = f"""explode(flatten(transform(sequence(0, char_length(word) - 1), s -> transform(sequence(1, least({vocabulary.longest}, char_length(word) - s)),
        l -> struct(s, l, substring(word, s + 1, l) as part)))))"""
    parts = words.select(*keys, F.expr(spans).alias("x")).select(*keys, "x.s", "x.l", "x.part")
    # the piece table has as many rows as the vocabulary
    met = parts.join(F.broadcast(pieces), parts["part"] == F.col("_piece"), "left").where("_id IS NOT NULL OR l = 1")
    if vocabulary.ranked:  # an edge in one number: order, begin, length, id
        edge = F.expr(f"(shiftleft(cast(coalesce(_order, {MOST_PIECES}) as bigint), 43) | shiftleft(cast(s as bigint), 25)) | shiftleft(cast(l as bigint), 20) | coalesce(_id, {NO_PIECE})")
    else:
        edge = F.struct(F.coalesce("_rank", F.lit(own[-1][0] + 10.0)).alias("rank"), "s", (F.col("s") + F.col("l")).alias("e"), F.coalesce("_id", F.lit(NO_PIECE)).alias("id"))
    return met.select(*keys, edge.alias("edge")).groupBy(*keys).agg(F.sort_array(F.collect_list("edge")).alias("edges"))


MOST_PIECES, NO_PIECE = (1 << 20) - 1, (1 << 20) - 1


def _spelt(vocabulary: Vocabulary, x: str) -> str:
    """The ids of an edge: its piece, or the bytes of its character."""
    code = f"hex(substring(word, {x}.s + 1, 1))"
    return f"""if({x}.id != {NO_PIECE}, array({x}.id), transform(sequence(1, octet_length({code}) div 2),
      i -> element_at({_ints(list(vocabulary.byte_ids))}, cast(conv(substr({code}, cast(2 * i - 1 as int), 2), 16, 10) as int) + 1)))"""


#: The edges unpacked: begin, end, id.
_UNPACKED = f"""transform(edges, x -> named_struct('s', cast(shiftright(x, 25) & 262143 as int),
  'e', cast((shiftright(x, 25) & 262143) + (shiftright(x, 20) & 31) as int), 'id', cast(x & {NO_PIECE} as int)))"""
#: Byte-pair merges over edges in rank order: an edge whose ends are symbol bounds with one bound between them drops it.
#: The bounds are the bits of a number.
_MERGE = """aggregate(spans, shiftleft(1L, char_length(word) + 1) - 1,
    (m, x) -> if(x.e - x.s > 1 AND (shiftright(m, x.s) & shiftright(m, x.e) & 1) = 1
        AND bit_count(shiftright(m, x.s + 1) & (shiftleft(1L, x.e - x.s - 1) - 1)) = 1, m & ~(shiftleft(1L, x.e) - shiftleft(1L, x.s + 1)), m),
    m -> filter(spans, x -> (shiftright(m, x.s) & shiftright(m, x.e) & 1) = 1 AND (shiftright(m, x.s + 1) & (shiftleft(1L, x.e - x.s - 1) - 1)) = 0))"""
#: Viterbi: to each end in turn, the best of the edges that lead there from the best path to their begin.
_VITERBI = """element_at(aggregate(sequence(1, char_length(word)), array(named_struct('score', 0D, 's', 0, 'path', cast(array() as array<int>))),
  (best, at) -> concat(best, array(array_max(transform(filter(edges, x -> x.e = at),
    x -> named_struct('score', best[x.s].score - x.rank, 's', x.s, 'path', concat(best[x.s].path, IDS))))))), -1).path"""


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``words`` with their ids: distinct words in the column ``word``, of LONGEST_WORD characters at most, any others beside it."""
    edges, keys = lattice(words, vocabulary), words.columns
    if not vocabulary.ranked:
        return edges.select(*keys, F.expr(_VITERBI.replace("IDS", _spelt(vocabulary, "x"))).alias("ids"))
    spans = edges.select(*keys, materialised(F.expr(_UNPACKED), "spans"))
    symbols = spans.select(*keys, materialised(F.expr(f"sort_array({_MERGE})"), "symbols"))
    blanks = f"(char_length(word) - char_length(ltrim('{SPACE}', word)))"
    spelt = f"x -> {_spelt(vocabulary, 'x')}"
    rest = f"flatten(transform(filter(symbols, x -> x.e > {blanks}), {spelt}))"
    if not vocabulary.runs:
        return symbols.select(*keys, F.expr(f"flatten(transform(symbols, {spelt}))").alias("ids"))
    # blanks that no word took: whole runs of the longest piece, then what is left
    long = max(vocabulary.runs)
    if not vocabulary.repeats:
        raise ValueError("the model's pieces of blanks do not repeat")
    left = f"size(filter(symbols, x -> x.e <= {blanks}))"
    table_ = f"array({','.join(_ints(vocabulary.run(n)) for n in range(long))})"
    led = f"concat(array_repeat({vocabulary.runs[long]}, cast({left} div {long} as int)), element_at({table_}, {left} % {long} + 1))"
    return symbols.select(*keys, F.expr(f"concat({led}, {rest})").alias("ids"))


def split_words(text: str) -> list[str]:
    return WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


class WordEncoder:
    """The same folds over the lattice of one word, for words that are not in the table. Ids come as bytes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        own = [(p, s, i) for p, s, i in vocabulary.pieces if not (len(p) > 1 and i in vocabulary.runs.values())]
        self.v, self.longest = vocabulary, vocabulary.longest
        self.rank = {p: -s for p, s, _ in own}
        self.ids = {p: packed([i]) for p, _, i in own}
        self.worst = max(self.rank.values(), default=0.0) + 10.0
        self.runs: dict[int, bytes] = {0: b""}

    def spelt(self, part: str) -> bytes:
        return self.ids.get(part) or packed([self.v.byte_ids[b] for b in part.encode()])

    def __call__(self, word: str) -> bytes:
        return self.merge(word) if self.v.ranked else self.viterbi(word)

    def merge(self, word: str) -> bytes:
        parts = self.symbols(word) if len(word) <= LONGEST_WORD else self.long_symbols(word)
        led = 0
        if self.v.runs:
            while led < len(parts) and parts[led] == SPACE:
                led += 1
        if led not in self.runs:
            self.runs[led] = packed(self.v.run(led))
        return self.runs[led] + b"".join(map(self.spelt, parts[led:]))

    def symbols(self, word: str) -> list[str]:
        parts, rank, never = list(word), self.rank.get, float("inf")
        ranks = [rank(word[i : i + 2], never) for i in range(len(word) - 1)]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
        return parts

    def long_symbols(self, word: str) -> list[str]:
        """The same merges from a heap of pairs: rank, begin, middle, end. A pair whose symbols have changed is passed over."""
        n, rank = len(word), self.rank.get
        end, begin = [*range(1, n + 1), 0], [0, *range(n)]  # of the symbol that begins, that ends at a place
        pairs = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(pairs)
        while pairs:
            _, a, b, c = heapq.heappop(pairs)
            if end[a] != b or end[b] != c:
                continue
            end[a], end[b], begin[c] = c, 0, a
            if a and (r := rank(word[begin[a] : c])) is not None:
                heapq.heappush(pairs, (r, begin[a], a, c))
            if c < n and (r := rank(word[a : end[c]])) is not None:
                heapq.heappush(pairs, (r, a, c, end[c]))
        out, at = [], 0
        while at < n:
            out.append(word[at : end[at]])
            at = end[at]
        return out

    def viterbi(self, word: str) -> bytes:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for e in range(1, len(word) + 1):
            edges = [(best[s][0] - self.rank[word[s:e]], s) for s in range(max(0, e - self.longest), e) if word[s:e] in self.rank]
            if not any(s == e - 1 for _, s in edges):
                edges.append((best[e - 1][0] - self.worst, e - 1))
            best.append(max(edges))
        out, e = [], len(word)
        while e:
            out.append(self.spelt(word[best[e][1] : e]))
            e = best[e][1]
        return b"".join(out[::-1])


def _rare(batches: Iterator[pa.RecordBatch], known: Broadcast) -> Iterator[pa.RecordBatch]:
    """The distinct words of each text that are not known."""
    for batch in batches:
        keys1, keys2, words = [], [], []
        for a, b, text in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "text")], strict=True):
            new = {w for w in split_words(text) if len(w) <= LONGEST_WORD} - known.value.keys()
            keys1 += [a] * len(new)
            keys2 += [b] * len(new)
            words += new
        yield pa.RecordBatch.from_arrays([pa.array(keys1, pa.int64()), pa.array(keys2, pa.int64()), pa.array(words, pa.string())], names=["k1", "k2", "word"])


MEMO = 100_000  # words that a task remembers beyond the table, long ones by their length


def spellings(vocabulary: Vocabulary) -> list[bytes]:
    """The bytes that each id stands for."""
    out = [b""] * (max(max(i for _, _, i in vocabulary.pieces), *vocabulary.byte_ids) + 1)
    for b, i in enumerate(vocabulary.byte_ids):
        if i != vocabulary.unknown:
            out[i] = bytes([b])
    for p, _, i in vocabulary.pieces:
        out[i] = p.encode()
    return out


def text_of(ids: np.ndarray, spelling: list[bytes]) -> str:
    s = b"".join(map(spelling.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE, " ")
    return s[1:] if s[:1] == " " else s


def _assemble(batches: Iterator[pa.RecordBatch], known: Broadcast, vocabulary: Vocabulary, check: bool) -> Iterator[pa.RecordBatch]:
    common, encoder, memo, size = known.value, WordEncoder(vocabulary), {}, 0
    spelling = spellings(vocabulary) if check else []

    def ids_of(w: str) -> bytes:
        nonlocal size
        ids = memo.get(w)
        if ids is None:
            if size >= MEMO:
                memo.clear()
                size = 0
            ids = memo[w] = encoder(w)
            size += 1 + len(w) // LONGEST_WORD
        return ids

    for batch in batches:
        rest = [c for c in batch.schema.names if c not in ("_text", "_words", "_ids")]
        joined = "_words" in batch.schema.names
        for i in range(0, batch.num_rows, 500):  # a few texts at a time: their ids are Python objects
            part = batch.slice(i, 500)
            lists = []
            brought = zip(part.column("_words").to_pylist(), part.column("_ids").to_pylist(), strict=True) if joined else ((None, None),) * part.num_rows
            texts = part.column("_text").to_pylist()
            for text, (words, ids) in zip(texts, brought, strict=True):
                other = dict(zip(words or (), map(packed, ids or ()), strict=True))
                lists.append(np.frombuffer(b"".join([common.get(w) or (other[w] if joined and len(w) <= LONGEST_WORD else ids_of(w)) for w in split_words(text)]), np.int32))
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) for x in lists], out=offsets[1:])
            flat = np.concatenate(lists) if lists else np.empty(0, np.int32)
            columns = [*[part.column(part.schema.names.index(c)) for c in rest], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
            if check:
                columns.append(pa.array([text_of(x, spelling) == t for x, t in zip(lists, texts, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "_pieces", *["_same"] * check])


def encode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", known_words: int = KNOWN_WORDS, rare: str = "task", round_trip: str | None = None) -> DataFrame:
    """``docs`` with the ids of each ``text``; empty for an empty or null one.

    ``known_words`` bounds the table of the commonest words that every task gets; ``rare`` says how others are encoded;
    ``round_trip`` names a column that says whether the ids decode to the text.
    Rows stay as they are, repeated ones too; a column called like the ids is replaced; names with an underscore in
    front are reserved. The blank and U+2581 are the same to the model.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spaced = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    if rare == "join":
        each = docs.where(text != "").select(F.explode(F.regexp_extract_all(spaced, F.lit(WORD.pattern), 0)).alias("word"))
    else:  # the common ones have one blank in front
        each = docs.select(F.explode(F.split(text, " ")).alias("part")).where("part <> ''").select(F.concat(F.lit(SPACE), "part").alias("word"))
    counted = each.where(F.char_length("word") <= LONGEST_WORD).groupBy("word").agg(F.count("*").alias("n"))
    # a word that comes once is not common
    counted = land(counted if rare == "join" else counted.where("n > 1"), "words")
    top = commonest(counted, "n", known_words).select("word")
    rows = encode_words(top.repartition("word"), vocabulary).toArrow()  # at most known_words
    known = docs.sparkSession.sparkContext.broadcast(dict(zip(rows.column("word").to_pylist(), map(packed, rows.column("ids").to_pylist()), strict=True)))
    rest = docs.drop(ids, *[round_trip] * bool(round_trip))
    schema = T.StructType([*rest.schema.fields, T.StructField("_pieces", T.ArrayType(T.IntegerType())), *[T.StructField("_same", T.BooleanType())] * bool(round_trip)])
    assemble = functools.partial(_assemble, known=known, vocabulary=vocabulary, check=bool(round_trip))
    names = {"_pieces": ids, **({"_same": round_trip} if round_trip else {})}
    if rare == "task":
        return rest.withColumn("_text", text).mapInArrow(assemble, schema).withColumnsRenamed(names)
    coded = land(encode_words(counted.select("word").repartition("word"), vocabulary), "coded")
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")]
    others = docs.select(*keys, text.alias("text")).mapInArrow(functools.partial(_rare, known=known), "k1 bigint, k2 bigint, word string")
    spelt = others.join(coded, "word").groupBy("k1", "k2").agg(F.collect_set(F.struct("word", "ids")).alias("w"))
    spelt = spelt.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("w.word").alias("_words"), F.col("w.ids").alias("_ids"))
    keyed = rest.withColumn("_a", keys[0]).withColumn("_b", keys[1]).withColumn("_text", text)
    both = keyed.join(spelt, (F.col("_a") == F.col("_k1")) & (F.col("_b") == F.col("_k2")), "left").drop("_a", "_b", "_k1", "_k2")
    return both.mapInArrow(assemble, schema).withColumnsRenamed(names)


def _decode(batches: Iterator[pa.RecordBatch], spelling: list[bytes], into: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("_ids")
        out = [text_of(x.values.to_numpy(zero_copy_only=False), spelling) if x.is_valid else "" for x in column]
        rest = [c for c in batch.schema.names if c != "_ids"]
        yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in rest], pa.array(out, pa.string())], names=[*rest, into])


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text that its ids spell; null ids spell an empty one, ids without a piece nothing."""
    spelling = spellings(vocabulary)
    size = len(spelling)
    rest = rows.drop(into)
    schema = T.StructType([*rest.schema.fields, T.StructField("_out", T.StringType())])
    inside = F.filter(F.col(ids), lambda i: i.isNotNull() & (i >= 0) & (i < size))
    return rest.withColumn("_ids", inside).mapInArrow(functools.partial(_decode, spelling=spelling, into="_out"), schema).withColumnRenamed("_out", into)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, load(), round_trip="round_trip")
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")
