"""N-gram Jaccard join by T-occurrence search with DivideSkip.

A document's set holds its distinct shingles of `k` words (A-Z lower-cased, ASCII white space between words; fewer words: the whole sequence
as one). Two documents link when their Jaccard similarity is at least `percent` / 100, in integers. To link, x must share T of its |x|
shingles, so up to |x| - T inverted lists may be left unread: DivideSkip merges the short lists of the rest and probes the long ones.

1. Documents with equal sets are one class; its least id stands for it (exact copies need no pairs).
2. Every class posts its shingles below a bound that depends on the set's size only and falls with it. Shingles are counted with map-side
   partial sums; lists of one are dropped. Below the bound of the largest set that could link with a document, whatever no other document
   posts no partner has, so a document with u such shingles need merge u lists fewer. Beyond that bound, a partner may have shingles
   that it doesn't post: these count as sharable.
3. A first search reads only the head of each list, its least document: each class merges the heads of its lists, and the document that
   occurs most often is probed. Links so found give components, so that a group of thousands of near copies is one component after about as
   many probes as it has members.
4. A list's entries are from now on the components that it meets, each with its members in blocks of BLOCK at most. Lists that meet more than
   `heavy` components are the long ones. They go last in the order of shingles, for all documents alike: a document's merged lists are the
   first |x| - T + 1 of its others that meet two components.
5. Each document gets the blocks of its merged lists that could hold a partner by size, and merges them: the sorted lists are the runs of a
   stable merge sort, equal entries are counted, and documents whose occurrences and unread lists can't reach the overlap T drop out.
6. The rest is probed in the lists left unread, by binary search: the sorted shingles of both, as arrays, one searched in the other. (A list
   is probed for a document through the document's sorted shingles, which answers the same question and moves no list.) No pair of different
   sets whose documents aren't already connected is left out, and there is no cap on lists, partners or candidates.
7. Documents whose posted lists held too few short ones post all their lists, which are counted in turn, before step 4 ends. Documents
   that still have fewer short lists than must be merged could share only long ones and such as a partner doesn't post, and only with
   each other: all of their lists are joined among themselves with a limit four times as large, and so on until none is left.

Rows: one output row for each input row. Null and empty texts, and texts of white space only, have empty sets and link with nothing;
rows that repeat an id are classed by their own sets; a null id has a null component; other columns are not read; empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit
from .graph import components
from .scratch import Scratch, among, attach

WORDS = 5
PERCENT = 80
HEAVY = 32
SALTS = 32
#: Members of a component in one block of a list, about.
BLOCK = 512
#: Sets of so many shingles or fewer are posted whole.
SMALL = 128


def shingle_sets(col: pa.Array, k: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes, below 2**63."""
    words = textkit.Words(col, lower=True)
    h = words.hashes()
    full = textkit.grams(h, k) >> np.uint64(1)
    short = {n: textkit.grams(h, n) for n in range(1, k)}
    out = []
    for a, n in zip(words.first[:-1].tolist(), words.count.tolist(), strict=True):
        if n >= k:
            own = np.sort(full[a : a + n - k + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            out.append(textkit.mix(short[n][a : a + 1] + np.uint64(n)) >> np.uint64(1))
        else:
            out.append(full[:0])
    return out


def prefix(n: int, percent: int) -> int:
    """Lists to merge: n - T + 1, where T = ceil(percent * n / 100)."""
    return n + (-percent * n) // 100 + 1


def bound(n: int, percent: int) -> int:
    """A set of n shingles posts those below it: all if few, else about p + p / 4 + 8 of them. It never rises with n."""
    return 1 << 63 if n <= SMALL else min(1 << 63, ((125 * (100 - percent) * n + 100_000) << 63) // (10_000 * n))


def _sets(docs: DataFrame, k: int, percent: int, whole: bool = False) -> DataFrame:
    """doc_id, n, p (lists to merge), f1 and f2 (fingerprint of the set), sure, tokens: those below bound(n); all, if whole.

    The first `sure` tokens are below the bounds of all sets that could link with this one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.pieces(batch, "text"):
                sets = shingle_sets(part.column("text"), k)
                n = [len(s) for s in sets]
                p = [prefix(x, percent) if x else 0 for x in n]
                f1 = [int(textkit.mix(s + np.uint64(1)).sum(dtype=np.uint64)) - (1 << 63) for s in sets]
                f2 = [int(textkit.mix(s ^ np.uint64(0x5DEECE66D1234567)).sum(dtype=np.uint64)) - (1 << 63) for s in sets]
                sure = [int(np.searchsorted(s, np.uint64(bound(100 * len(s) // percent, percent)))) for s in sets]
                held = [s if whole else s[: np.searchsorted(s, np.uint64(bound(len(s), percent)))] for s in sets]
                flat = np.concatenate(held) if held else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, p, f1, f2, sure)), textkit.long_lists(flat, np.array([len(s) for s in held]))], names=["doc_id", "n", "p", "f1", "f2", "sure", "tokens"])

    return textkit.map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n long, p long, f1 long, f2 long, sure long, tokens array<long>")


def probe(pairs: DataFrame, sets: DataFrame, percent: int, salts: int = SALTS) -> DataFrame:
    """The links (a, b) among pairs (a, b), by binary search between the sorted shingles of both (doc, tokens: all of them).

    A document a with many partners is spread over `salts` tasks.
    """
    text = sets.select(F.col("doc").alias("id"), "tokens")
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(salts)).alias("s"))
    held = pairs.select("a", "s").distinct().join(text, F.col("a") == F.col("id")).select("a", "s", F.lit(0).alias("kind"), F.col("a").alias("b"), "tokens")
    asked = pairs.join(text, F.col("b") == F.col("id")).select("a", "s", F.lit(1).alias("kind"), "b", "tokens")
    rows = held.unionByName(asked).repartition("a", "s").sortWithinPartitions("a", "s", "kind", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []
        for batch in batches:
            a, s, kind, b = (batch.column(i).to_pylist() for i in range(4))
            first = np.asarray(batch.column("tokens").offsets)
            flat = np.asarray(batch.column("tokens").values)
            left, right = [], []
            for i in range(len(a)):
                got = flat[first[i] : first[i + 1]]
                if key != (a[i], s[i]):
                    key, own = (a[i], s[i]), []
                if kind[i] == 0:
                    own.append(got.copy())
                    continue
                for other in own:
                    few, many = (got, other) if len(got) <= len(other) else (other, got)
                    if not len(few):
                        continue
                    both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                    if 100 * both >= percent * (len(few) + len(many) - both):
                        left.append(a[i])
                        right.append(b[i])
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return textkit.map_arrow(rows, run, "a long, b long")


_MEMBER = ("doc", "n", "s", "cut", "unread")


def merge(rows: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) from rows (the _MEMBER columns of a document, members: a block of a list that it merges).

    The blocks of a document are merged, equal entries counted; an entry stays if the occurrences, and the lists that only one of both left
    unread, can reach the overlap. All lists up to the smaller cut are merged for both, so only that document's unread lists can add.
    """
    rows = rows.repartition("doc").sortWithinPartitions("doc")
    shares = 1 + 100 / percent + 1e-9

    def candidates(part: pa.RecordBatch) -> pa.RecordBatch:
        members = part.column("members")
        entry = {c: np.asarray(x) for c, x in zip(_MEMBER, members.flatten().flatten(), strict=True)}
        size = np.asarray(members.value_lengths())
        own = {c: np.repeat(np.asarray(part.column(c)), size) for c in _MEMBER}
        order = np.lexsort((entry["doc"], own["doc"]))  # stable: the sorted blocks are its runs
        x, y = own["doc"][order], entry["doc"][order]
        first = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))) if len(x) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(x)))
        at = order[first]
        p, q = ({c: side[c][at] for c in _MEMBER} for side in (own, entry))
        need = (percent * (p["n"] + q["n"]) + 99 + percent) // (100 + percent)
        fits = (100 * p["n"] >= percent * q["n"]) & (100 * q["n"] >= percent * p["n"]) & (np.minimum(p["s"], q["s"]) >= need)
        fits &= p["n"] / p["s"] + q["n"] / q["s"] <= shares
        unread = np.where(p["cut"] < q["cut"], p["unread"], np.where(p["cut"] > q["cut"], q["unread"], np.minimum(p["unread"], q["unread"])))
        fits &= times + unread >= need
        a, b = p["doc"][fits], q["doc"][fits]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the blocks of the last document, whose others may be in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            doc = np.asarray(batch.column("doc"))
            begin = int(np.searchsorted(doc, doc[-1]))
            if begin or (held and held[0].column("doc")[0].as_py() != doc[0]):
                yield candidates(pa.concat_batches([*held, batch.slice(0, begin)]))
                held = []
            held.append(batch.slice(begin))
        if held:
            yield candidates(pa.concat_batches(held))

    return textkit.map_arrow(rows, run, "a long, b long")


class Join:
    """One join over a table of documents (doc_id, text)."""

    def __init__(self, docs: DataFrame, k: int = WORDS, percent: int = PERCENT, heavy: int = HEAVY, name: str = "ngram-join"):
        self.docs, self.k, self.percent, self.heavy = docs.select("doc_id", "text"), k, percent, heavy
        self.scratch = Scratch(docs.sparkSession, name)

    def classes(self) -> tuple[DataFrame, DataFrame]:
        """(doc_id, n, rep) for every row with an id and a set, and the postings of the representatives."""
        keep = self.scratch.table
        sets = keep(_sets(self.docs.where("doc_id is not null"), self.k, self.percent), "sets")
        full = sets.where("n > 0").select("doc_id", "n", "f1", "f2")
        least = keep(full.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("times")), "least")
        none = sets.where("n = 0").select("doc_id", "n", F.lit(None).cast("long").alias("rep"))
        members = keep(attach(full, least, ["f1", "f2", "n"], sets.count()).select("doc_id", "n", "rep").unionByName(none), "members")
        reps = members.where("doc_id = rep").select("doc_id", "n").distinct()
        postings = keep(sets.join(reps, ["doc_id", "n"], "left_semi").select(F.col("doc_id").alias("doc"), "n", "p", "sure", "tokens"), "postings")
        self.scratch.drop(sets)
        return members, postings

    def shared(self, postings: DataFrame) -> DataFrame:
        """The postings of lists that two or more have: token, doc, rank, safe (all partners post it), first (the list's first document)."""
        each = self._each(postings)
        lists = self.scratch.table(each.groupBy("token").agg(F.count("*").alias("c"), F.min("doc").alias("first")).where("c > 1").select("token", "first"), "lists")
        return self.scratch.table(each.join(lists, "token"), "shared")

    def heads(self, postings: DataFrame, shared: DataFrame) -> DataFrame:
        """Links between a document and the head of its lists that occurs most often, if that is in two fifths of those it must merge."""
        met = shared.where("first <> doc").groupBy("doc", "first").agg(F.count("*").alias("m")).join(self._sizes(postings), "doc").where("5 * m >= 2 * p")
        best = met.groupBy("doc").agg(F.max_by("first", F.struct("m", -F.col("first"))).alias("a"))
        return self.probed(best.select("a", F.col("doc").alias("b")))

    @staticmethod
    def _each(postings: DataFrame) -> DataFrame:
        return postings.select("doc", "sure", F.posexplode("tokens").alias("rank", "token")).select("doc", "rank", "token", (F.col("rank") < F.col("sure")).alias("safe"))

    @staticmethod
    def _sizes(postings: DataFrame) -> DataFrame:
        return postings.select("doc", "n", "p", "sure", F.size("tokens").alias("held"))

    def probed(self, pairs: DataFrame) -> DataFrame:
        keep = self.scratch.table
        pairs = keep(pairs, "pairs")
        ids = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
        sets = keep(self._whole(ids).select("doc", "tokens"), "sets")
        found = keep(probe(pairs, sets, self.percent), "found")
        self.scratch.drop(pairs)
        self.scratch.drop(sets)
        return found

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Members as classes() gives them, and links (a, b) between representatives that connect whatever is connected."""
        members, postings = self.classes()
        shared = self.shared(postings)
        found = self.heads(postings, shared)
        return members, self.rest(postings, shared, found, self.heavy)

    def rest(self, postings: DataFrame, shared: DataFrame, found: DataFrame, heavy: int) -> DataFrame:
        """found and the links that it leaves out between documents that it doesn't connect."""
        keep = self.scratch.table
        comp = keep(components(found, self.scratch), "components")
        own = keep(self._with_components(shared, comp), "own")
        self.scratch.drop(shared)
        sizes = keep(self._sizes(postings), "sizes")
        whole: list[DataFrame] = []
        while True:
            met = keep(own.groupBy("token", "comp").agg(F.count("*").alias("m")).groupBy("token").agg(F.count("*").alias("c"), F.sum("m").alias("size")).where("c > 1"), "met")
            rows = own.join(met, "token")
            # What a document can share with another component (s), and of how many of those lists, short ones first, one must be shared (q).
            able = rows.groupBy("doc").agg(F.count_if("safe").alias("met"), F.count_if(F.col("c") <= heavy).alias("short"))
            able = sizes.join(able, "doc", "left").withColumns({"met": F.coalesce("met", F.lit(0)), "short": F.coalesce("short", F.lit(0))})
            able = able.select("doc", "n", "held", "short", (F.col("met") + F.col("n") - F.col("sure")).alias("s"), (F.col("met") + F.col("p") - F.col("sure")).alias("q")).where("q >= 1")
            ends = keep(able, "ends")
            few = ends.where("short < q and held < n").select("doc", "n", "held")
            if few.isEmpty():
                break
            whole.append(keep(self._whole(few), "whole"))
            more = keep(self._extended(own, [postings, *whole], few, comp), "own")
            new = keep(sizes.join(whole[-1].select("doc"), "doc", "left_anti").unionByName(self._sizes(whole[-1])), "sizes")
            for old in (own, met, ends, sizes):
                self.scratch.drop(old)
            own, sizes = more, new
        pairs = self.pairs(own, met, ends, heavy)
        found = found.unionByName(self.probed(pairs))
        # Two documents with fewer short lists than must be merged, all posted, may share none of them: they are joined among themselves.
        hard = ends.where("short < q").select("doc")
        if hard.limit(2).count() < 2:
            return found
        left = keep(self._whole(hard).withColumn("sure", F.col("n")), "whole")  # all partners post all
        return self.rest(left, self.shared(left), found, 4 * heavy)

    def pairs(self, own: DataFrame, met: DataFrame, ends: DataFrame, heavy: int) -> DataFrame:
        """Pairs (a, b) of different components that occur together in merged lists often enough to reach the overlap.

        A document merges its first q short lists. Both documents' bounds s hold for a pair, so that n / s of one and of the other add up to
        1 + 100 / percent at most. Of two components, the members of the one with the greater number get the other's blocks.
        """
        rows = own.join(met.where(F.col("c") <= heavy).select("token", "size"), "token").join(ends.select("doc", "n", "s", "q"), "doc")
        of_doc = Window.partitionBy("doc")
        rows = rows.withColumn("k", F.row_number().over(of_doc.orderBy("rank"))).where("k <= q")
        # Beyond its last merged list, a document has only unread ones.
        rows = rows.select("token", "size", "doc", "comp", "n", "s", F.max("token").over(of_doc).alias("cut"), (F.col("s") - F.count("*").over(of_doc)).alias("unread"))
        rows = self.scratch.table(rows, "merged")
        block = F.pmod(F.xxhash64("doc"), F.ceil(F.col("size") / BLOCK))
        lists = rows.groupBy("token", F.col("comp").alias("other"), block.alias("block")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min(F.col("n") / F.col("s")).alias("share"), F.sort_array(F.collect_list(F.struct(*_MEMBER))).alias("members"))
        pct, n = F.lit(self.percent), F.col("n")
        fits = (F.lit(100) * F.col("most") >= pct * n) & (F.lit(100) * n >= pct * F.col("least")) & (n / F.col("s") + F.col("share") <= F.lit(1 + 100 / self.percent + 1e-9))
        return merge(rows.join(lists, "token").where((F.col("other") < F.col("comp")) & fits).select(*_MEMBER, "members"), self.percent)

    def _with_components(self, rows: DataFrame, comp: DataFrame) -> DataFrame:
        return rows.join(comp, rows["doc"] == comp["node"], "left").select("token", "doc", "rank", "safe", F.coalesce("component", "doc").alias("comp"))

    def _whole(self, docs: DataFrame) -> DataFrame:
        """Postings of all lists of these documents."""
        texts = among(self.docs, self.scratch.table(docs.select(F.col("doc").alias("doc_id")).distinct(), "ids"), "doc_id")
        return _sets(texts, self.k, self.percent, whole=True).select(F.col("doc_id").alias("doc"), "n", "p", "sure", "tokens")

    def _extended(self, own: DataFrame, tables: list[DataFrame], few: DataFrame, comp: DataFrame) -> DataFrame:
        """own with the lists that the last table posts anew, whole."""
        extra = self._each(tables[-1]).join(few.select("doc", "held"), "doc").where("rank >= held").drop("held")
        tokens = self.scratch.table(extra.select("token").distinct(), "tokens")
        rows = extra
        for table in tables[:-1]:
            rows = rows.unionByName(among(self._each(table), tokens, "token").select(*rows.columns))
        rows = self.scratch.table(rows.dropDuplicates(["token", "doc"]), "rows")
        rows = rows.join(rows.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"), "token", "left_semi")
        return own.join(tokens, "token", "left_anti").unionByName(self._with_components(rows, comp))

    def groups(self) -> DataFrame:
        """doc_id, n (set size), component: one row for each row with an id."""
        members, links = self.links()
        comp = self.scratch.table(components(links, self.scratch), "components")
        return members.join(comp, members["rep"] == comp["node"], "left").select("doc_id", "n", F.coalesce("component", "rep", "doc_id").alias("component"))


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text)."""
    out = Join(docs, k, percent, heavy).groups().select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    lost = docs.where("doc_id is null").select(F.col("doc_id").cast("long"), "text")
    sizes = _sets(lost, k, percent).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(sizes)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
