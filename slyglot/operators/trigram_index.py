"""A stored trigram index for substring search (A7, F1): many terms, any number of times.

Posts are stored in slices of up to 1,024 rows, in the order they came. For every trigram
the index holds a posting list for each slice: which rows of the slice contain it. Lists
are dealt by hash of the trigram and sorted, so a search reads the lists it needs. A term
is looked up by its rarest trigrams, and the rows on all their lists are verified in the
stored text. Many terms would each have most slices as candidates, so the texts of the
slices that their rarest trigrams are in are read once for all, and searched through longer
q-grams (see ``lexicon_join.lowered_hits``); then work grows with the texts and the hits,
not with terms times slices. New posts are a new segment; what is stored is neither read
nor rebuilt.

A trigram is one long of three code points. Texts end in two empty code points, so every
character starts a trigram and terms of one or two characters are prefixes of trigrams.

The first posts of each term are wanted, and a posting list says what the smallest post
id of its slice is. So a search goes in waves over the slices, those of small ids first:
a few, then several times more for the terms that are not finished, until every term has
enough posts below the next wave or no slice is left. A common term ends in the first
wave, and a rare one has short lists.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slyglot.operators.lexicon_join import build_side, is_small, lowered_hits, settled
from slyglot.operators.topk import top_k_per_key

#: Rows of a slice, as a power of two.
SLICE = 10
#: Rarest trigrams of a term whose lists are intersected.
RARE = 3
#: Slices of the first wave, and how many times more each next one has.
FIRST_SLICES, MORE = 4, 8
BUCKETS = 64
#: Terms that are looked up row by row at most; more are searched together in the slices they may be in.
FEW_TERMS = 1000
#: Terms that one task verifies in a slice, about.
TERMS = 100_000
AT = ["segment", "slice"]
#: Where a post is stored.
PLACE = [*AT, "row"]


def packed(a: Column, b: Column, c: Column) -> Column:
    """Three code points as one long."""
    return F.shiftleft(a, 42).bitwiseOR(F.shiftleft(b, 21)).bitwiseOR(c)


def _posting_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of each trigram over the rows of a slice in a batch."""
    for batch in batches:
        slices, rows, ids = (batch.column(i).to_numpy() for i in range(3))
        texts = batch.column(3).to_pylist()
        cuts = np.r_[0, np.flatnonzero(np.diff(slices)) + 1, len(slices)] if len(slices) else np.zeros(1, np.int64)
        for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = []
            for text in texts[begin:end]:
                points = np.frombuffer((text + "\0\0").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
                own.append(np.unique((points[:-2] << 42) | (points[1:-1] << 21) | points[2:]))
            grams = np.concatenate(own)
            order = np.argsort(grams, kind="stable")  # runs that are sorted already
            grams = grams[order]
            on = np.repeat(rows[begin:end], [len(g) for g in own])[order]
            starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(grams)], pa.int32()), pa.array(on.astype(np.int16)))
            same = [pa.array(np.full(len(starts), v)) for v in (slices[begin], ids[begin:end].min())]
            yield pa.RecordBatch.from_arrays([*same, pa.array(grams[starts]), lists], ["slice", "low", "gram", "rows"])


class TrigramIndex:
    """The index in folder ``path``, which all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, posts: DataFrame, segment: int) -> None:
        """Add ``(post_id, url, text)`` rows as a segment; the same segment again replaces it.

        Texts are stored, then read once for their lists, which alone are shuffled. Posts
        without a text are in no list.
        """
        number = F.monotonically_increasing_id()
        stored = posts.select("post_id", "url", F.lower("text").alias("lowered")).filter(F.length("lowered") > 0)
        stored = stored.withColumn("_n", number).select(
            F.shiftright("_n", SLICE).alias("slice"), F.col("_n").bitwiseAND(F.lit((1 << SLICE) - 1)).cast("short").alias("row"), "post_id", "url", "lowered")
        stored.write.mode("overwrite").parquet(f"{self.path}/posts/segment={segment}")
        texts = self.spark.read.parquet(f"{self.path}/posts/segment={segment}")
        texts = texts.select("slice", "row", F.col("post_id").cast("long").alias("post_id"), "lowered")
        lists = texts.mapInArrow(_posting_lists, "slice long, low long, gram long, rows array<short>")
        bucket = F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int")
        dealt = lists.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", "gram", "low")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/lists/segment={segment}")
        stored = self.spark.read.parquet(f"{self.path}/lists/segment={segment}")
        counts = stored.groupBy("gram").agg(F.sum(F.size("rows")).alias("n"))
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/segment={segment}")

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}")

    def _rarest(self, cut: DataFrame) -> DataFrame:
        """``(pos, gram, others)``: each term's rarest trigram and the next ones; no term that cannot be there."""
        grams = cut.filter(F.size("p") > 2).select("pos", F.explode(F.array_distinct(F.transform(
            F.sequence(F.lit(0), F.size("p") - 3), lambda i: packed(F.get("p", i), F.get("p", i + 1), F.get("p", i + 2))))).alias("gram"))
        counts = self._read("counts").groupBy("gram").agg(F.sum("n").alias("n"))
        known = grams.join(counts.hint("merge"), "gram", "left").select("pos", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("g"))
        listed = known.groupBy("pos").agg(F.array_sort(F.collect_list("g")).alias("all")).filter(F.col("all")[0]["n"] > 0)
        return listed.select("pos", F.col("all")[0]["gram"].alias("gram"), F.slice(F.col("all.gram"), 2, RARE - 1).alias("others"))

    def _waves(self, slices: DataFrame) -> list[int]:
        """Post ids that part the waves, from a sketch of the smallest ids of ``slices``."""
        count = slices.count()
        shares = [FIRST_SLICES * MORE ** i / count for i in range(60) if FIRST_SLICES * MORE ** i < count]
        found = slices.agg(F.percentile_approx("low", shares, 10_000)).first()[0] if shares else []
        return sorted(set(found))

    def _candidates(self, lists: DataFrame, rare: DataFrame, short: DataFrame) -> DataFrame:
        """``(pos, segment, slice, rows)``: the rows of a slice that are on the lists of all of a term's rarest trigrams.

        Only the shortest list of a term goes along with it, the others are looked up.
        """
        piece = ["pos", *AT, "low"]
        met = lists.join(rare, "gram").select(*piece, "others", "rows")
        for i in range(RARE - 1):
            other = lists.select(F.col("gram").alias("other"), *AT, "low", F.col("rows").alias("more"))
            met = met.withColumn("other", F.get("others", F.lit(i))).join(other, ["other", *AT, "low"], "left")
            both = F.array_intersect("rows", F.coalesce("more", F.array().cast("array<short>")))
            rows = F.when(F.col("other").isNull(), F.col("rows")).otherwise(both)
            met = met.select(*piece, "others", rows.alias("rows")).filter(F.size("rows") > 0)
        return met.select("pos", *AT, "rows").union(self._begun(lists, short, F.col("rows")))

    def _begun(self, lists: DataFrame, short: DataFrame, rows: Column) -> DataFrame:
        """``(pos, segment, slice, rows)``: where trigrams that begin with a short term are."""
        begins = F.explode(F.array(F.shiftright("gram", 42), F.shiftright("gram", 21))).alias("prefix")
        return lists.select(*AT, rows.alias("rows"), begins).join(short, "prefix").select("pos", *AT, "rows")

    def _together(self, lists: DataFrame, rare: DataFrame, terms: DataFrame) -> DataFrame:
        """``(pos, post_id, segment, slice, row)``: all posts that hold a term of ``rare``, in the slices its rarest trigram may be in."""
        grams = settled(rare.select("gram").distinct(), "open-grams")
        slices = settled(lists.join(build_side(grams, is_small(grams)), "gram", "left_semi").select(*AT).distinct(), "asked-slices")
        posts = self._read("posts").join(build_side(slices, is_small(slices)), AT, "left_semi").select(*PLACE, "post_id", "lowered")
        wanted = settled(terms.join(rare.select("pos"), "pos", "left_semi").select("pos", "pattern"), "open-patterns")
        hits = lowered_hits(posts, wanted, [*PLACE, "post_id"])
        return hits.join(build_side(wanted, is_small(wanted)), "pattern").select("pos", "post_id", *PLACE)

    def _verified(self, asked: DataFrame, terms: DataFrame, limit: int) -> DataFrame:
        """``(pos, post_id, segment, slice, row)``: the first ``limit`` posts of each slice that hold a term asked of it.

        A task has the texts of one slice, and up to about ``TERMS`` terms.
        """
        groups = max(1, -(-terms.count() // TERMS))
        share = F.pmod(F.xxhash64("pos"), F.lit(groups)).cast("int").alias("share")
        slices = settled(asked.select(*AT).distinct(), "asked-slices")
        posts = self._read("posts").join(build_side(slices, is_small(slices)), AT, "left_semi")
        posts = posts.select(*AT, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("share"), "row", "post_id", "url", "lowered")
        wanted = asked.join(terms.select("pos", "pattern"), "pos").select(*AT, share, "pos", "pattern", "rows")
        kinds = {f.name: f.dataType.simpleString() for f in posts.schema}

        def hits(stored: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            """Texts in the order of their ids, each read once for all patterns that may be in it."""
            stored = stored.sort_values(["post_id", "url"]) if len(stored) else stored
            terms = ahocorasick.Automaton()
            for pattern, pos in zip(asked["pattern"], asked["pos"]):
                terms.get(pattern, None) or terms.add_word(pattern, (pattern, []))
                terms.get(pattern)[1].append(pos)
            needed = np.ones(1 << 15, bool)
            if len(asked) and asked["rows"].notna().all():
                needed[:] = False
                for rows in asked["rows"]:
                    needed[np.asarray(rows, np.int64)] = True
            pos, at, seen = [], [], Counter()
            if len(asked):
                terms.make_automaton()
            for i, (row, text) in enumerate(zip(stored["row"], stored["lowered"])):
                if len(asked) and needed[row]:
                    for pattern, owners in dict(value for _, value in terms.iter(text)).items():
                        seen[pattern] += 1
                        if seen[pattern] <= limit:
                            pos += dict.fromkeys(owners)
                            at += [i] * len(set(owners))
            found = stored.iloc[at]
            return pd.DataFrame({"pos": pos, **{c: found[c].to_numpy() for c in ("post_id", *PLACE)}})

        key = [*AT, "share"]
        together = posts.groupBy(*key).cogroup(wanted.groupBy(*key))
        return together.applyInPandas(hits, "pos long, " + ", ".join(f"{c} {kinds[c]}" for c in ("post_id", *PLACE)))

    def search(self, terms: DataFrame, limit: int) -> DataFrame:
        """``(pos, term, post_id, url)``: the first ``limit`` posts by id of every ``(pos, term)``.

        ``pos`` names a term, each once. A term is found anywhere in a text, in lower case;
        an empty or NULL term finds nothing. A post id that is stored twice is found twice.
        """
        terms = settled(terms.select(F.col("pos").cast("long").alias("pos"), "term", F.lower("term").alias("pattern")).filter("term <> ''"), "terms")
        points = F.transform(F.split("pattern", ""), lambda c: F.ascii(c).cast("long"))
        cut = terms.select("pos", F.filter(points, lambda p: p > 0).alias("p"))
        rare = settled(self._rarest(cut), "rare-grams")
        # one code point as such, two together: a prefix of the trigrams that begin with them
        two = F.shiftleft(F.get("p", F.lit(0)), 21).bitwiseOR(F.get("p", F.lit(1)))
        short = cut.filter(F.size("p").between(1, 2)).select("pos", F.coalesce(F.when(F.size("p") == 2, two), F.get("p", F.lit(0))).alias("prefix"))
        short = settled(short, "short-terms")
        row_by_row = terms.count() <= FEW_TERMS
        slices = settled(self._read("lists").groupBy(*AT).agg(F.min("low").alias("low")), "slices")
        few_slices = is_small(slices)
        left, found, begin = terms.select("pos"), [], None
        for end in [*self._waves(slices), None]:
            now = slices
            for bound, test in ((begin, F.col("low") >= begin if begin is not None else None), (end, F.col("low") < end if end is not None else None)):
                now = now if bound is None else now.filter(test)
            lists = self._read("lists").join(build_side(now.select(*AT), few_slices), AT, "left_semi")
            open_rare, open_short = rare.join(left, "pos", "left_semi"), short.join(left, "pos", "left_semi")
            if row_by_row:
                asked = self._candidates(lists, open_rare, open_short)
            else:
                found.append(settled(self._together(lists, open_rare, terms), "term-hits"))
                asked = self._begun(lists, open_short, F.lit(None).cast("array<short>")).distinct()
            asked = settled(asked, "candidates")
            if row_by_row or not asked.isEmpty():
                found.append(settled(self._verified(asked, terms, limit), "term-hits"))
            if end is None:
                break
            begin = end
            done = _union(found).filter(F.col("post_id") < end).groupBy("pos").agg(F.count("*").alias("n")).filter(F.col("n") >= limit)
            left = settled(left.join(done, "pos", "left_anti"), "open-terms")
            if left.isEmpty():
                break
        # posts of one id, which their URLs part, stay together until those are read
        first = F.rank().over(Window.partitionBy("pos").orderBy("post_id"))
        near = _union(found).withColumn("_rank", first).filter(F.col("_rank") <= limit).drop("_rank")
        near = near.join(self._read("posts").select(*PLACE, "url"), PLACE).select("pos", "post_id", "url")
        best = top_k_per_key(near, "pos", [F.col("post_id"), F.col("url")], limit)
        return best.join(terms.select("pos", "term"), "pos").select("pos", "term", "post_id", "url")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)
