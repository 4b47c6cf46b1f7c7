"""Exact top-k BM25 search: an inverted index with block-max WAND per shard, merged with global statistics.

Terms are lower-cased words between ASCII white space, compared by 63 hash bits. Document frequencies, the number of documents
and their mean length are global, so every shard scores alike and the merge of the shards' lists is exact.

A shard orders its documents by likeness, near copies together, and cuts the range of their places into blocks. Each term has one posting list, in that
order; it is cut at the same block ends, and each piece keeps its largest impact. A search never reads a piece before it must:

- A block's bound is the sum of the weighted largest impacts of the pieces in it. Blocks are visited in falling order of their bounds, some at
  a time, until no bound left reaches the limit, the k-th best score found so far. The postings of the other blocks are skipped. Where this spares few
  postings of rare terms (`WHOLE`), the lists of these are read whole instead, and a block's bound is the most that they give one of its documents,
  with the largest impacts of the frequent terms' pieces.
- In a visited block, the lists of the rarer terms are moved over the block first. A document is a pivot if what they add up to, with the
  largest impacts of the frequent terms' lists there, reaches the limit. The frequent terms' lists follow in steps, heaviest first, in blocks that still have
  a pivot only; each step leaves fewer pivots. Their pieces hold an impact for each place of the block, and `TOGETHER` queries share the reading of a
  piece: what it gives all queries with a pivot in the block is one product of matrices.

Some shards, about as many as the square root of their number, are searched first. The k-th best score of their documents is the limit that
the search of every other shard begins with.

All this is done in single precision, with the rounding errors taken off the limit. The few documents that reach it are scored anew, from their own
terms: added up term by term in falling order of weight, in doubles, and rounded to `DIGITS` digits, so a score does not depend on
shards or blocks. Queries are taken `QUERIES` at a time; every such part meets every shard.

A query's text counts each of its words as often as it holds it.

Defined cases: null ids take no part; of repeated query ids the alphabetically smallest text is searched; repeated rows are candidates
each, but never rows with the query's id. Texts without words match nothing. Documents that share no term with a
query are not returned, so a query may have fewer than k rows. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm import common

K1, B = 1.2, 0.75
SHARD = 16384  # documents
BLOCK = 128
#: Blocks visited at first; each further step takes four times as many.
FIRST_VISIT = 4
#: Lists of terms that a larger share of a shard's documents hold have an impact for each place, also where it is zero.
FREQUENT = 1 / 24
#: Steps in which the lists of frequent terms are read, heaviest first; each leaves fewer blocks with a pivot.
STEPS = 3
QUERIES = 1 << 16
#: Queries that are searched together.
TOGETHER = 512
#: The lists of rare terms are read whole where searches by pieces read a larger share of them.
WHOLE = 0.5
#: Pairs of a document and a term that a step of building a shard's index takes at a time.
PART = 1 << 20
#: Document frequencies held by a task before they are handed on.
COUNTED = 2_000_000
DIGITS = 6


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return common.hashed_words(pc.ascii_split_whitespace(pc.utf8_lower(common.plain_texts(texts))))


def _counted(stream: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms in order, and the (document, term) pairs in order with their counts."""
    terms, codes = np.unique(stream, return_inverse=True)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    pairs, count = np.unique(owner * max(1, len(terms)) + codes, return_counts=True)
    return terms, pairs // max(1, len(terms)), pairs % max(1, len(terms)), count


def inverse_frequency(documents: int, df: np.ndarray) -> np.ndarray:
    return np.log(1 + (documents - df + 0.5) / (df + 0.5))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of some ranges, one range after the other."""
    return _owned_ranges(start, size)[1]


def _owned_ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of each number, and all numbers, one range after the other."""
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
    return owner, (start - (end - size)).take(owner) + np.arange(len(owner))


class Shard:
    """The index of some documents, with what search needs of the whole collection.

    `postings` and `read` count the postings of all searches: those of the queries' terms, and those read.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, doc: np.ndarray, term: np.ndarray, count: np.ndarray, mean_length: float):
        """doc, term and count are the pairs, by document and then term."""
        n = len(ids)
        self.postings = self.read = 0
        self.norm, self.terms, self.blocks = K1 * (1 - B + B * lengths / mean_length), terms, -(-n // BLOCK)
        self.begin = np.searchsorted(doc, np.arange(n + 1, dtype=doc.dtype))
        self.term, self.count = term.astype(np.int32, copy=False), count.astype(np.min_scalar_type(count.max(initial=0)))
        del term, count
        impact = np.concatenate([np.zeros(0, np.float32)] + [self._impact(doc[own], self.count[own]).astype(np.float32) for own in map(self._pairs, self._parts(self.begin))])
        self.order = np.lexsort((lengths, self._sign(), self._likeness(impact)))
        place = np.empty(n, np.int32)
        place[self.order] = np.arange(n)
        self.ids, self.df = ids[self.order], np.bincount(self.term, minlength=len(terms))

        frequent = self.df > n * FREQUENT
        rare = ~frequent[self.term]
        # the rarer of them weigh most and are read first
        by_weight = np.flatnonzero(frequent)[np.argsort(self.df[frequent], kind="stable")]
        self.row = np.full(len(terms), -1, np.int32)
        self.row[by_weight] = np.arange(len(by_weight))
        self.full = np.zeros((self.blocks, len(by_weight), BLOCK), np.float32)
        own = np.flatnonzero(~rare)
        at = place[doc[own]]
        self.full[at // BLOCK, self.row[self.term[own]], at % BLOCK] = impact[own]
        self.full_most = np.ascontiguousarray(self.full.max(axis=2, initial=0).T)
        self.full_size = np.count_nonzero(self.full, axis=2).T.astype(np.float32)
        self.slot = np.full(len(terms), -1, np.int32)
        #: postings of rare terms in the lists of queries that were searched by pieces, and those read
        self.rare_postings = self.rare_read = 0

        done, of, start = 0, [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        self.doc, self.impact = np.empty(np.count_nonzero(rare), np.int32), np.empty(np.count_nonzero(rare), np.float32)
        for first, end in self._parts(np.append(0, np.cumsum(np.where(frequent, 0, self.df)))):
            own = np.flatnonzero(rare & (self.term >= first) & (self.term < end))
            own = own[np.argsort(self.term[own] * np.int64(n) + place[doc[own]])]
            at = place[doc[own]]
            self.doc[done : done + len(own)], self.impact[done : done + len(own)] = at, impact[own]
            new = np.flatnonzero(np.append(True, np.diff(self.term[own] * np.int64(self.blocks) + at // BLOCK) != 0)[: len(own)])
            of.append(self.term[own[new]])
            start.append((new + done).astype(np.int32))
            done += len(own)
        of, start = np.concatenate(of), np.concatenate(start)
        self.piece_at = np.append(start, np.int32(len(self.doc)))
        self.block = (self.doc[start] // BLOCK).astype(np.uint16 if self.blocks < 1 << 16 else np.int32)
        self.most = np.maximum.reduceat(self.impact, start) if len(start) else self.impact
        self.term_at = np.searchsorted(of, np.arange(len(terms) + 1, dtype=np.int32))

    @staticmethod
    def _parts(begin: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of about `PART` pairs, by what each document's or term's pairs begin at."""
        cuts = np.unique(np.append(np.searchsorted(begin, np.arange(0, begin[-1], PART)), [0, len(begin) - 1])).tolist()
        return list(zip(cuts[:-1], cuts[1:], strict=True))

    def _pairs(self, part: tuple[int, int]) -> slice:
        return slice(self.begin[part[0]], self.begin[part[1]])

    def _impact(self, doc: np.ndarray, count: np.ndarray) -> np.ndarray:
        return count * (K1 + 1) / (count + self.norm[doc])

    def _over_pairs(self, reduce: np.ufunc, values, dtype) -> np.ndarray:
        """For each document, `reduce` over the `values` of its pairs, given a range of pairs; zero without pairs."""
        out = np.zeros(len(self.begin) - 1, dtype)
        for part in self._parts(self.begin):
            own, begin = slice(*part), self.begin[part[0] : part[1] + 1]
            some = np.diff(begin) > 0
            if some.any():
                out[own][some] = reduce.reduceat(values(self._pairs(part)), begin[:-1][some] - begin[0])
        return out

    def _sign(self) -> np.ndarray:
        """The least of each document's mixed terms, which near copies mostly share."""
        mixed = common.mixed(self.terms.astype(np.uint64))
        return self._over_pairs(np.minimum, lambda own: mixed[self.term[own]], np.uint64)

    def _likeness(self, impact: np.ndarray, groups: int = 8) -> np.ndarray:
        """A group for each document, that of the most similar one of some unlike documents."""
        if not len(impact):
            return np.zeros(len(self.begin) - 1, np.int64)
        length = np.sqrt(np.maximum(self._over_pairs(np.add, lambda own: impact[own] * impact[own], np.float32), 1e-30))

        def similar(seed: int) -> np.ndarray:
            own = slice(self.begin[seed], self.begin[seed + 1])
            vector = np.zeros(len(self.terms), np.float32)
            vector[self.term[own]] = impact[own] / length[seed]
            return self._over_pairs(np.add, lambda own: impact[own] * vector[self.term[own]], np.float32) / length

        similarity = [similar(int(np.searchsorted(self.begin, np.argmax(impact), "right")) - 1)]
        while len(similarity) < groups:
            similarity.append(similar(int(np.argmin(np.max(similarity, axis=0)))))
        return np.argmax(similarity, axis=0)

    def _exact(self, places: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of some places, added up in the order of `at`."""
        some = max(1, PART // max(len(at), len(self.term) // len(self.order)))
        if len(places) > some:  # large groups of copies
            return np.concatenate([self._exact(places[i : i + some], at, weights) for i in range(0, len(places), some)])
        doc = self.order[places]
        size = self.begin[doc + 1] - self.begin[doc]
        own = [slice(a, a + n) for a, n in zip(self.begin[doc].tolist(), size.tolist(), strict=True)]
        self.slot[at] = np.arange(len(at))
        slot = self.slot.take(np.concatenate([self.term[x] for x in own]))
        self.slot[at] = -1
        hit = np.flatnonzero(slot >= 0)
        owner, slot = np.repeat(np.arange(len(doc)), size)[hit], slot[hit]
        added = np.zeros((len(doc), len(at)))
        added[owner, slot] = self._impact(doc[owner], np.concatenate([self.count[x] for x in own])[hit]) * weights[slot]
        return np.cumsum(added, axis=1)[:, -1]

    def search(self, query_id, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple]:
        """(id, score) of the k best documents; terms in order."""
        return self.search_all([(query_id, terms, weights)], k)[0]

    def search_all(self, queries: list[tuple], k: int, least: np.ndarray | None = None) -> list[list[tuple]]:
        """`search` for each (id, terms, weights); some queries at a time share the reading of frequent terms' lists.

        `least` has a score for each query; documents of lower scores may be left out.
        """
        least, out = np.zeros(len(queries)) if least is None else least, []
        while len(out) < len(queries):
            whole = self.rare_read > WHOLE * self.rare_postings
            some = slice(len(out), len(out) + (TOGETHER if whole else TOGETHER // 8))
            out += self._together(queries[some], k, least[some], whole)
        return out

    def _known(self, queries: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The numbers and weights of each query's terms that this shard has, in falling order of weight."""
        distinct, which = np.unique(np.concatenate([np.zeros(0, np.int64), *(terms for _, terms, _ in queries)]), return_inverse=True)
        number = np.minimum(np.searchsorted(self.terms, distinct), max(0, len(self.terms) - 1))
        number = np.where(self.terms[number] == distinct, number, -1)[which] if len(self.terms) else np.full(len(which), -1)
        out, done = [], 0
        for _, terms, weights in queries:
            at = number[done : done + len(terms)]
            done += len(terms)
            at, weights = at[at >= 0], np.asarray(weights)[at >= 0]
            order = np.lexsort((at, -weights))
            out.append((at[order], weights[order]))
        return out

    def _rare(self, at: np.ndarray, weights: np.ndarray, total: np.ndarray) -> None:
        """Adds what the whole lists of some rare terms give to all places."""
        begin = self.piece_at[self.term_at[at]]
        size = self.piece_at[self.term_at[at + 1]] - begin
        spots = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        self.read += len(spots)
        np.add.at(total, self.doc.take(spots).astype(np.int64), self.impact.take(spots) * np.repeat(weights, size))

    def _together(self, queries: list[tuple], k: int, least: np.ndarray, whole: bool) -> list[list[tuple]]:
        """Searches queries block by block. `whole`: the lists of rare terms are read at once, and bounds are taken from what they give."""
        known = self._known(queries)
        some = [i for i, (at, _) in enumerate(known) if len(at)]
        out = [[] for _ in queries]
        if not some:
            return out
        known, own_id = [known[i] for i in some], np.array([queries[i][0] for i in some], dtype=self.ids.dtype)
        full_weights = np.zeros((len(some), self.full.shape[1]), np.float32)
        total = np.zeros((len(some), self.blocks * BLOCK), np.float32)
        in_blocks = total.reshape(len(some), self.blocks, BLOCK)
        bound, pieces = np.zeros((len(some), self.blocks), np.float32), []
        for q, (at, weights) in enumerate(known):
            self.postings += int(self.df[at].sum())
            row = self.row[at]
            full_weights[q, row[row >= 0]] = weights[row >= 0]
            short, short_weights = at[row < 0], weights[row < 0].astype(np.float32)
            if whole:
                self._rare(short, short_weights, total[q])
                continue
            size = self.term_at[short + 1] - self.term_at[short]
            piece, weight = _ranges(self.term_at[short], size), np.repeat(short_weights, size)
            bound[q] = np.bincount(self.block[piece], self.most[piece] * weight, minlength=self.blocks)
            pieces.append((piece, weight))
            self.rare_postings += int(self.df[short].sum())
        if whole:
            bound = in_blocks.max(axis=2)
        step = max(1, -(-self.full.shape[1] // STEPS))
        full_parts = [slice(begin, begin + step) for begin in range(0, self.full.shape[1], step)]
        by_part = [np.ascontiguousarray(full_weights[:, part]) for part in full_parts]
        #: what the lists of frequent terms can add in a block, from each step's first on
        rest = [full_weights[:, part.start :] @ self.full_most[part.start :] for part in full_parts] + [np.zeros_like(bound)]
        bound = bound + rest[0]
        # sums are taken in single precision and different orders, and ties are those of rounded scores
        slack = 2.5e-7 * (np.array([len(at) for at, _ in known]) + 4) * bound.max(axis=1) + 2 * 10.0**-DIGITS
        order = np.argsort(-bound, axis=1, kind="stable")
        # rounded down, as limits are kept in single precision
        limit = np.nextafter(np.maximum(least[some] - slack, 0).astype(np.float32), np.float32(0))
        found = [(np.zeros(0), np.zeros(0, np.int64))] * len(some)
        begin, size = 0, FIRST_VISIT
        while begin < self.blocks:
            now = order[:, begin : begin + size]
            reached = np.take_along_axis(bound, now, axis=1)
            q, at = np.nonzero((reached >= limit[:, None]) & (reached > 0))
            if not len(q):
                break
            block = now[q, at]
            begin, size = begin + size, size * 4
            if not whole:
                visited = np.zeros((len(some), self.blocks), bool)
                visited[q, block] = True
                for i, (piece, weight) in enumerate(pieces):
                    mine = np.flatnonzero(visited[i].take(self.block.take(piece)))
                    first = self.piece_at.take(piece[mine])
                    owner, spots = _owned_ranges(first, self.piece_at.take(piece[mine] + 1) - first)
                    self.read += len(spots)
                    self.rare_read += len(spots)
                    np.add.at(total[i], self.doc.take(spots).astype(np.int64), self.impact.take(spots) * weight[mine].take(owner))
            hits = self._visited(q, block, in_blocks, full_parts, by_part, rest, limit)
            other = self.ids[hits[1]] != own_id[hits[0]]
            q, place, score = (x[other] for x in hits)
            ends = np.searchsorted(q, np.arange(len(some) + 1))
            for i in np.unique(q).tolist():
                new = slice(ends[i], ends[i + 1])
                scores, places = np.append(found[i][0], score[new]), np.append(found[i][1], place[new])
                if len(scores) >= k:
                    own = np.partition(scores, len(scores) - k)[len(scores) - k] - slack[i]
                    limit[i] = max(limit[i], np.nextafter(np.float32(own), np.float32(-np.inf)))
                    keep = scores >= limit[i]
                    scores, places = scores[keep], places[keep]
                found[i] = scores, places
        for i, (at, weights), (_, places), query in zip(some, known, found, own_id, strict=True):
            places = places[self.ids[places] != query]
            best = [(j, round(x, DIGITS)) for j, x in zip(self.ids[places].tolist(), self._exact(places, at, weights).tolist(), strict=True)] if len(places) else []
            out[i] = sorted((x for x in best if x[1] > 0), key=lambda x: (-x[1], x[0]))[:k]
        return out

    def _visited(self, query, block, in_blocks, full_parts, by_part, rest, limit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score, by query, of what reaches a query's limit in blocks that it visits, given each pair of them."""
        by_block = np.lexsort((query, block))
        query, block = query[by_block], block[by_block]
        cuts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
        reads = [np.zeros((self.blocks, len(limit)), np.float32) for _ in full_parts]
        hits = []
        for begin, end in zip(cuts, [*cuts[1:], len(block)], strict=True):
            at, q = int(block[begin]), query[begin:end]
            sums, least = in_blocks[q, at], limit[q]
            for part, weights, left, read in zip(full_parts, by_part, rest, reads, strict=False):
                pivot = sums.max(axis=1) + left[q, at] >= least
                if not pivot.all():
                    q, sums, least = q[pivot], sums[pivot], least[pivot]
                    if not len(q):
                        break
                read[at, q] = 1
                sums += weights[q] @ self.full[at, part]
            which, spot = np.nonzero((sums >= least[:, None]) & (sums > 0))
            hits.append((q[which], at * BLOCK + spot, sums[which, spot]))
        for part, weights, read in zip(full_parts, by_part, reads, strict=True):
            self.read += int((read @ (weights > 0).astype(np.float32) * self.full_size[part].T).sum(dtype=np.float64))
        query, place, score = (np.concatenate(x) for x in zip(*hits, strict=True))
        by_query = np.argsort(query, kind="stable")
        return query[by_query], place[by_query], score[by_query].astype(float)


def _frequencies(runs: DataFrame) -> DataFrame:
    """term and df; under term 0 the number of texts with words and under term 1 that of their words."""

    def counted(batches):
        terms, counts, size = [], [], 0

        def merged():
            distinct, which = np.unique(np.concatenate(terms), return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(np.bincount(which, weights=np.concatenate(counts)).astype(np.int64))], ["term", "df"])

        for batch in batches:
            for run in zip(*batch.columns, strict=True):
                sizes, distinct, term = (packed.as_buffer() for packed in run)
                sizes, distinct = common.unpack(sizes, np.int64), common.sums(distinct)
                terms += [distinct, np.array([0, 1])]
                counts += [np.bincount(common.unpack(term, np.int32), minlength=len(distinct)), np.array([(sizes > 0).sum(), sizes.sum()])]
                size += len(distinct)
                if size > COUNTED:
                    yield merged()
                    terms, counts, size = [], [], 0
        if terms:
            yield merged()

    return runs.select("sizes", "terms", "term").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _shard(shards: int) -> Column:
    """The shard of a run: a partition's runs go to one shard after the other, from a first one that is spread evenly over all partitions."""
    first = F.floor(F.pmod(F.col("partition") * 0.6180339887498949, F.lit(1.0)) * shards)
    return F.pmod(first + F.col("run"), F.lit(shards)).cast("int")


def search(rows: DataFrame, is_query: Column, k: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """query_id, rank, doc_id and score. `is_query` is a condition on `doc_id`."""
    rows = common.columns(rows, doc_id=key, text=text).filter("doc_id IS NOT NULL")
    kind = common.kind(rows, "doc_id")

    def indexed(batches):
        partition, run = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                some = batch.slice(at, 4000)
                stream, sizes = term_hashes(some.column("text"))
                terms, doc, term, count = _counted(stream, sizes)
                keys = some.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition], pa.int32()), pa.array([run], pa.int32()), pa.ListArray.from_arrays([0, len(keys)], keys)]
                    + [pa.array([x], pa.binary()) for x in (common.pack(sizes), common.steps(terms), common.pack(np.bincount(doc, minlength=len(sizes))), common.pack(term.astype(np.int32)), common.pack(count.astype(np.int32)))],
                    ["partition", "run", "ids", "sizes", "terms", "per_doc", "term", "count"],
                )
                run += 1

    runs = common.written(rows.mapInArrow(indexed, f"partition int, run int, ids array<{kind}>, sizes binary, terms binary, per_doc binary, term binary, count binary"), "index")
    frequencies = common.written(_frequencies(runs), "frequencies")
    totals = {r.term: r.df for r in frequencies.filter("term < 2").collect()}
    documents, mean_length = totals.get(0, 0), totals.get(1, 0) / max(1, totals.get(0, 0))
    shards = max(1, -(-documents // SHARD))

    def spelled(batches):
        for batch in batches:
            stream, sizes = term_hashes(batch.column("text"))
            terms, doc, term, count = _counted(stream, sizes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array(terms[term]), pa.array(count)], ["query_id", "term", "times"])

    asked = rows.filter(is_query).groupBy("doc_id").agg(F.min("text").alias("text")).select("doc_id", "text")
    asked = asked.mapInArrow(spelled, f"query_id {kind}, term long, times long")
    # a word of one document only matches the query itself
    asked = asked.join(frequencies.filter("df > 1 AND term > 1"), "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "times", "df"))).alias("terms"))

    def packed(batches):
        for batch in batches:
            rows = [pd.DataFrame(list(x)) for x in batch["terms"].map(lambda x: [r.asDict() if hasattr(r, "asDict") else r for r in x])]
            yield pd.DataFrame({
                "query_id": batch["query_id"], "terms": [common.steps(r["term"].to_numpy(np.int64)) for r in rows],
                "weights": [common.pack(r["times"].to_numpy(np.int32)) for r in rows], "df": [common.pack(r["df"].to_numpy(np.int64)) for r in rows],
            })

    queries = common.written(asked.mapInPandas(packed, f"query_id {kind}, terms binary, weights binary, df binary"), "queries")
    parts = max(1, -(-queries.count() // QUERIES))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    runs = runs.withColumn("shard", _shard(shards))

    def merged(index: pd.DataFrame) -> tuple[np.ndarray, ...]:
        terms = [common.sums(x) for x in index["terms"]]
        distinct = np.unique(np.concatenate(terms))
        sizes, per_doc = (np.concatenate([common.unpack(x, np.int64) for x in index[c]]) for c in ("sizes", "per_doc"))
        term = np.concatenate([np.searchsorted(distinct, t).astype(np.int32)[common.unpack(x, np.int32)] for t, x in zip(terms, index["term"], strict=True)])
        count = np.concatenate([common.unpack(x, np.int32) for x in index["count"]])
        return np.concatenate([np.asarray(x) for x in index["ids"]]), sizes, distinct, np.repeat(np.arange(len(sizes), dtype=np.int32), per_doc), term, count

    def found(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        hits = []
        if len(index) and len(queries):
            index = index.sort_values(["partition", "run"])
            ids, sizes, distinct, *pairs = merged(index)
            del index
            shard = Shard(ids, sizes, distinct, *pairs, mean_length)
            del pairs
            for start in range(0, len(queries), TOGETHER):
                now = queries.iloc[start : start + TOGETHER]
                some = [
                    (query.query_id, common.sums(query.terms), common.unpack(query.weights, np.int32) * inverse_frequency(documents, common.unpack(query.df, np.int64)))
                    for query in now.itertuples()
                ]
                hits += [(own[0], i, s) for own, best in zip(some, shard.search_all(some, k, now["least"].to_numpy()), strict=True) for i, s in best]
        return pd.DataFrame(hits, columns=["query_id", "doc_id", "score"])

    def best(begin: int, end: int, queries: DataFrame, *others: DataFrame) -> DataFrame:
        """The k best of some shards and of other lists."""
        index = runs.filter(F.col("shard").between(begin, end - 1)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(begin), F.lit(end - 1))))
        lists = index.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(found, f"query_id {kind}, doc_id {kind}, score double")
        for other in others:
            lists = lists.union(other)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
        return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")

    # what the first shards' documents reach is the least that the others' are searched for
    first = max(1, round(shards**0.5))
    if first == shards:
        return best(0, shards, queries.withColumn("least", F.lit(0.0)))
    begun = common.written(best(0, first, queries.withColumn("least", F.lit(0.0))), "first")
    least = begun.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    return best(first, shards, queries.join(least, "query_id", "left").fillna(0.0, ["least"]), begun.select("query_id", "doc_id", "score"))
