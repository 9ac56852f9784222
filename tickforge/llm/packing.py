"""Packing by lexical retrieval: BM25 neighbours fill each seed's window.

1. Texts become token ids, once, in a written table; the token that ends a
   document is appended.  The same pass counts in how many documents each
   token occurs; these counts are bounded by the vocabulary, so the
   frequencies over all documents are gathered and broadcast.
2. Documents are dealt into shards of bounded size by what they say.  Of a
   document's distinct tokens, ``COORDS`` weighted MinHash functions pick one
   each, rare tokens more often (``deal_key``); documents are sorted by these
   picks: cut into ranges at keys of a sample of ``SAMPLE`` documents a range,
   shuffled once, sorted, and each range's stream is cut into shards as it is
   read.  So copies and documents with the same rare tokens lie in one shard or
   next to each other, at any size of the corpus and whatever the number of
   shuffle partitions; a hot key is cut by a hash of the document and the row's
   number.  Each shard builds an inverted BM25 index of its documents, with the
   frequencies and the mean length of the whole corpus.
3. Whole windows of a long document are sequences of their own.  Of the tails,
   the longest unused one is the seed; unused neighbours fill its window by
   descending BM25 score, the last one cut to fit (its rest stays unused).  What
   is left, less than a window, goes on to the range's next shard.  So all
   sequences of a range are full but the last, which is cut into powers of two,
   and those need no padding.

Memory is one shard and the longest text.  The retrieval is that of a shard: a
neighbour that shares no picked token with the seed is found only if it happens
to lie in the shard (measured shares: README).

Every id lies in exactly one piece; offsets in a sequence have no gaps.  A null
or empty text is one document of the end token alone.  Ties go to the smaller
id, then the smaller ids.  Repeated rows and rows with the same id are
packed as documents of their own; null ids come last.  Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.arrowtext import U64, mix, pieces
from tickforge.llm.common import documents, public_id, written
from tickforge.llm.fingerprints import _listed

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 1 << 19
#: Shards of a range, the number of ranges beyond which they get longer, and
#: the documents looked at for each range's bounds.
SHARDS_A_PART = 4
MAX_PARTS = 1 << 15
SAMPLE = 64
K1, B = 1.2, 0.75
COORDS = 4
SEQUENCES_A_PART = 1 << 32


class Tokenizer:
    """Ids of a byte-level BPE file of the ``tokenizers`` library.

    Texts go through a faster encoder with the same vocabulary, whose merge
    order is the order of ids.  ``check`` compares the two.  A text that holds
    the string of a special token goes through ``tokenizers`` itself.
    """

    PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def __init__(self, path: str):
        import tiktoken
        import tokenizers

        self.slow = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        # the printable stand-ins of the 256 bytes
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in self.special}
        self.fast = tiktoken.Encoding("fast", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(max(ranks.values()), END_ID, *(x["id"] for x in spec.get("added_tokens", []))) + 1

        # the smallest unsigned type that holds every id
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")

    def encode(self, text: str) -> list[int]:
        if any(x in text for x in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def check(self, texts: list[str]) -> None:
        for x in texts:
            if self.encode(x) != self.slow.encode(x, add_special_tokens=False).ids:
                raise ValueError("the tokenizer's merges are not in the order of its ids")


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One a worker process."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def races(size: int) -> np.ndarray:
    """COORDS x size: each function's arrival time of each token.  A token comes
    first with a probability in proportion to its weight; ids of a vocabulary
    are in the order of merges, so the logarithm of an id tells its rarity."""
    token = np.arange(size, dtype=U64)
    weight = np.log2(2.0 + np.arange(size))
    out = []
    for k in range(COORDS):
        u = (mix(mix(token + U64(1)) ^ U64(k + 1)) >> U64(11)).astype(np.float64) / (1 << 53)
        out.append(-np.log(u + 2.0 ** -54) / weight)
    out = np.array(out)
    out[:, END_ID] = np.inf
    return out


def deal_key(distinct: np.ndarray, times: np.ndarray) -> int:
    """The tokens that come first, 16 bits of a hash of each, as one long."""
    first = distinct[times[:, distinct].argmin(1)].astype(U64)
    bits = (mix(first + (np.arange(COORDS, dtype=U64) << U64(32))) >> U64(48)).tolist()
    key = 0
    for x in bits:
        key = key << 16 | x
    return key - (1 << 63)


TOKENS = "id long, ids binary, deal long, tie long, counts binary"


def _encode(path: str):
    names = ["id", "ids", "deal", "tie", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        times = races(tok.size)
        seen = np.zeros(tok.size, np.int64)
        rows = total = 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text").to_pylist()
                if rows == 0:
                    tok.check(texts[:1])
                ids = [np.array(tok.encode(x) + [END_ID], tok.kind) for x in texts]
                deals = []
                for x in ids:
                    distinct = np.unique(x)
                    seen[distinct] += 1
                    deals.append(deal_key(distinct, times))
                raw = [x.tobytes() for x in ids]
                # equal keys: by a hash of the document, then by the row's number
                tie = [zlib.crc32(x, d & 0xFFFFFFFF) << 31 | (rows + i) & 0x7FFFFFFF
                       for i, (x, d) in enumerate(zip(raw, piece.column("id").to_pylist()))]
                rows += len(ids)
                total += sum(map(len, ids))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array(raw, pa.binary()), pa.array(deals, pa.int64()),
                     pa.array(tie, pa.int64()), pa.nulls(len(ids), pa.binary())], names=names)
        if rows:
            # the task's document frequencies, then its documents and tokens
            none = [pa.array([None], k) for k in (pa.int64(), pa.binary(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([np.append(seen, [rows, total]).tobytes()], pa.binary())], names=names)
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column("counts").to_pylist():
            n = np.frombuffer(x, np.int64)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["token", "n"])


class Index:
    """BM25 index of the documents of one shard."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float):
        got = [np.unique(x, return_counts=True) for x in docs]
        self.terms = [t for t, _ in got]
        token = np.concatenate(self.terms)
        tf = np.concatenate([c for _, c in got])
        doc = np.repeat(np.arange(len(docs)), [len(t) for t in self.terms])
        size = np.array([len(x) for x in docs])[doc]
        idf = np.log1p((n_docs - df[token] + 0.5) / (df[token] + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
        order = np.argsort(token, kind="stable")
        self.doc, self.weight = doc[order].astype(np.int32), weight[order]
        self.known, first = np.unique(token[order], return_index=True)
        self.first = np.append(first, len(order))

    def scores(self, seed: int) -> np.ndarray:
        """Of all documents, for the distinct tokens of the seed."""
        at = np.searchsorted(self.known, self.terms[seed])
        a, n = self.first[at], self.first[at + 1] - self.first[at]
        rows = np.arange(n.sum()) + np.repeat(a - np.cumsum(n) + n, n)
        return np.bincount(self.doc[rows], self.weight[rows], len(self.terms))


def pack_shard(docs: list[np.ndarray], start: np.ndarray, df: np.ndarray, n_docs: int, mean: float, window: int,
               last: bool = True) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard's
    documents, which come in their order of preference, from ``start`` on;
    ``start`` is moved behind what is packed.  Less than a window stays, unless
    the shard is the ``last``."""
    pieces_, sequence = [], 0
    for d, x in enumerate(docs):
        while len(x) - start[d] >= window:
            pieces_.append((d, int(start[d]), window, sequence, 0))
            start[d] += window
            sequence += 1
    left = np.array([len(x) for x in docs]) - start
    by_size = list(np.argsort(left, kind="stable"))
    total = int(left.sum())
    if total >= window:
        index = Index(docs, df, n_docs, mean)
    while total >= window:
        while not left[by_size[-1]]:
            by_size.pop()
        seed = by_size[-1]
        score = index.scores(seed)
        score[left == 0] = -1.0
        score[seed] = np.inf
        used = 0
        while used < window:
            d = int(score.argmax())
            n = min(int(left[d]), window - used)
            pieces_.append((d, int(start[d]), n, sequence, used))
            start[d] += n
            left[d] -= n
            used += n
            score[d] = -1.0
        total -= window
        sequence += 1
    # what is left: sequences as long as powers of two
    room = used = 0
    for d in by_size[::-1] if last else ():
        while left[d]:
            if not room:
                room, used = 1 << (total.bit_length() - 1), 0
            n = min(int(left[d]), room)
            pieces_.append((int(d), int(start[d]), n, sequence, used))
            start[d] += n
            left[d] -= n
            used += n
            room -= n
            total -= n
            sequence += not room
    return pieces_


def _pack(sent, window: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, mean, kind = sent.value
        part, sequence = -1, 0
        shard: list[tuple[int, bytes, int]] = []  # (id, ids, where its rest begins)
        held = 0

        def packed(last: bool) -> pa.RecordBatch:
            nonlocal shard, held, sequence
            shard.sort(key=lambda x: x[:2])
            own = [np.frombuffer(x, kind).astype(np.uint32) for _, x, _ in shard]
            start = np.array([a for *_, a in shard], np.int64)
            found = pack_shard(own, start, df, n_docs, mean, window, last)
            d, a, n, number, offset = np.array(found, np.int64).reshape(-1, 5).T
            ids = [own[i][b:b + m].astype("<u4").tobytes() for i, b, m in zip(d, a, n)]
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard[i][0] for i in d], pa.int64()), pa.array(a), pa.array(n),
                 pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([len(own[i]) for i in d], pa.int64()),
                 pa.array(sequence + number), pa.array(offset), pa.array(ids, pa.binary())],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
            sequence += int(number.max()) + 1 if len(number) else 0
            shard = [(i, x, int(b)) for (i, x, _), b, o in zip(shard, start, own) if b < len(o)]
            held = sum(len(x) // kind.itemsize - b for _, x, b in shard)
            return out

        for batch in batches:
            for own, key, x in zip(*(batch.column(c).to_pylist() for c in ("part", "id", "ids"))):
                if own != part:
                    if shard:
                        yield packed(True)
                    part, sequence = own, own * SEQUENCES_A_PART
                shard.append((key, x, 0))
                held += len(x) // kind.itemsize
                if held >= shard_tokens:
                    yield packed(False)
        if shard:
            yield packed(True)
    return run


def _part(texts: DataFrame, parts: int, n_docs: int) -> Column:
    """The number of a document's range of (deal, tie).  The ranges hold about
    as many tokens each; their bounds are keys of a sample by hash, of about
    SAMPLE x parts documents."""
    every = max(1, n_docs // (SAMPLE * parts))
    some = texts.where(F.pmod(F.xxhash64("deal", "tie"), F.lit(every)) == 0) \
        .select("deal", "tie", F.octet_length("ids").alias("n")).toArrow()
    deal, tie, size = (some.column(c).to_numpy().astype(np.int64) for c in ("deal", "tie", "n"))
    order = np.lexsort([tie, deal])
    ends = np.cumsum(size[order])
    share = np.arange(1, parts) * (ends[-1] / parts) if len(ends) else np.zeros(0)
    at = order[np.unique(np.searchsorted(ends, share))]
    deals, ties = _listed(deal[at].tolist(), "bigint"), _listed(tie[at].tolist(), "bigint")

    def halves(low, step):  # the number of cuts that are not above the key
        cut = low + step - 1
        d = F.get(deals, cut)
        return F.when((d < F.col("deal")) | ((d == F.col("deal")) & (F.get(ties, cut) <= F.col("tie"))), low + step) \
            .otherwise(low)

    steps = [1 << k for k in reversed(range(len(at).bit_length()))]
    return F.aggregate(_listed(steps, "int"), F.lit(0), halves) if steps else F.lit(0)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids): one row for each piece; ids are unsigned 32-bit little-endian."""
    spark = docs.sparkSession
    tokens = written(documents(docs, id_col, text_col).mapInArrow(_encode(path), TOKENS), "tokens")
    counts = tokens.where("counts is not null").select("counts").mapInArrow(_spread, "token long, n long") \
        .groupBy("token").agg(F.sum("n").alias("n")).toArrow()  # one row for each token of the vocabulary at most
    size, kind = tokenizer(path).size, tokenizer(path).kind
    n = np.zeros(size + 2, np.int64)
    n[counts.column("token").to_numpy()] = counts.column("n").to_numpy()
    df, n_docs, total = n[:size], int(n[size]), int(n[size + 1])
    sent = spark.sparkContext.broadcast((df, n_docs, total / max(1, n_docs), kind))
    shard_tokens = max(shard_tokens, window)
    parts = min(MAX_PARTS, total // (SHARDS_A_PART * shard_tokens) + 1)
    texts = tokens.where("counts is null")
    dealt = texts.withColumn("part", _part(texts, parts, n_docs)).repartition("part") \
        .sortWithinPartitions("part", "deal", "tie")
    out = dealt.select("part", "id", "ids").mapInArrow(
        _pack(sent, window, shard_tokens), "id long, start long, length long, ids_crc32 long, doc_tokens long,"
                                           " sequence_id long, offset long, ids binary")
    return out.select(public_id().alias(id_col), *[c for c in out.columns if c != "id"])
