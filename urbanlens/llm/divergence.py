"""How far the sources of a language differ in their terms, all pairs, by a cube of tasks.

Terms are runs of letters (ASCII letters and all non-ASCII characters), A-Z
lower-cased.  A language keeps the terms of at least ``min_docs`` of its
documents.  A group, a (language, source) that occurs, gives each kept term
the smoothed share ``p = 1 + floor(10^9 * (count + 2) / (N + 2 * V))``; two
groups diverge by the sum of ``floor((p - q)^2 / (p + q))`` over all V kept
terms.  Whole numbers throughout.

1. Each task counts (language, source, term) in whole Arrow batches, with the
   documents that hold it; Spark adds the counts up.
2. Sums per language and term decide what is kept; sums per group and per
   language give N and V.  Groups are joined to their counts with hot groups
   by broadcast (``common.join_unique``).
3. A language's groups fall into blocks of about ``GROUP_BLOCK`` and its terms
   into blocks of about ``TERM_BLOCK``, both by hash.  A cell of the cube is
   (group block, group block, term block).  The slice of shares of one group
   block and one term block goes to every cell that needs it, with one row for
   each group, whether it has a term there or not.
4. A cell's task fills two small matrices and sums each pair of groups over its
   terms; kept terms that no group of the cell has count with the shares of a
   zero count.  The cells' sums are added along the term axis.

A cell holds about 2 * GROUP_BLOCK * TERM_BLOCK numbers whatever the input.
Pairs of all sources of a language are the result itself.

Defined results: null text, language or source is the empty string; every row
is a document, also with a null or repeated id; a language without kept terms
gives value 0 for all pairs; a language with one source gives no pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from urbanlens.llm.arrow_words import NO_LETTER, split_words
from urbanlens.llm.common import cut, join_unique, text_of

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
GROUP_BLOCK = 32
TERM_BLOCK = 4_096


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: occurrences and documents of each term in each group."""
    for batch in batches:
        rows, words, spelled = split_words(text_of(batch, "text"), NO_LETTER)
        if not len(rows):
            continue
        codes = [batch.column(c).dictionary_encode() for c in ("lang", "source")]
        langs, sources = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
        groups, group = np.unique(langs * len(codes[1].dictionary) + sources, return_inverse=True)
        found, n = np.unique(group[rows] * len(spelled) + words, return_counts=True)
        in_row = np.unique(rows * len(spelled) + words)
        docs = np.unique(group[in_row // len(spelled)] * len(spelled) + in_row % len(spelled), return_counts=True)[1]
        at, term = np.divmod(found, len(spelled))
        lang, source = np.divmod(groups[at], len(codes[1].dictionary))
        yield pa.RecordBatch.from_arrays(
            [codes[0].dictionary.take(pa.array(lang)).cast(pa.string()),
             codes[1].dictionary.take(pa.array(source)).cast(pa.string()),
             spelled.take(pa.array(term)).view(pa.string()), pa.array(n), pa.array(docs)],
            names=["lang", "source", "term", "n", "docs"])


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents with it."""
    texts = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                        for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])
    counted = texts.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact beyond 64 bits."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"),
                           (total + 2 * terms).cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(df: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The groups (grp, lang, source, n_all, n_terms, zero) and their terms (lang, grp, term, p, q).

    ``zero`` is the share of a kept term that the group lacks, ``q`` that of
    the language.  Both tables are written to the shared folder.
    """
    counts = cut(term_counts(df, text_col, lang_col, source_col), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= min_docs).drop("docs")
    name = F.concat(F.length("lang").cast("string"), F.lit(":"), F.col("lang"), F.col("source"))
    rows = cut(counts.drop("docs").join(kept, ["lang", "term"]).withColumn("grp", name), "divergence-kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("in_lang").alias("lang_all"))
    every = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                        for n, c in (("lang", lang_col), ("source", source_col))]).distinct().withColumn("grp", name)
    sums = rows.groupBy("grp").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("held"))
    groups = every.join(sums, "grp", "left").join(langs, "lang", "left").na.fill(0)
    # A language without kept terms has no share to give.
    zero = F.when(F.col("n_terms") > 0, _share(F.lit(0), F.col("n_all"), F.col("n_terms")))
    groups = cut(groups.withColumn("zero", zero), "divergence-groups")
    met = join_unique(rows, groups.select("grp", "n_all", "lang_all", "n_terms", "held"), "grp", "held")
    met = met.select("lang", "grp", "source", "term", _share(F.col("n"), F.col("n_all"), F.col("n_terms")).alias("p"),
                     _share(F.col("in_lang"), F.col("lang_all"), F.col("n_terms")).alias("q"))
    return groups, cut(met, "divergence-shares")


def _cell(cell: pa.Table) -> pa.Table:
    """Partial divergences of all pairs of one cell: rows without a term name its groups."""
    is_group = cell.column("term").is_null()
    markers, rows = cell.filter(is_group), cell.filter(pc.invert(is_group))
    markers = markers.sort_by([("block", "ascending"), ("source", "ascending")])
    sources, blocks = markers.column("source").combine_chunks(), markers.column("block").to_numpy()
    zero = np.nan_to_num(markers.column("p").to_numpy()).astype(np.int64)
    terms = rows.column("term").combine_chunks().dictionary_encode()
    table = np.repeat(zero[:, None], len(terms.dictionary), axis=1)
    table[pc.index_in(rows.column("source").combine_chunks(), sources).to_numpy(zero_copy_only=False),
          terms.indices.to_numpy(zero_copy_only=False)] = rows.column("p").to_numpy()
    absent = (markers.column("in_block")[0].as_py() or 0) - len(terms.dictionary)
    low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
    first, second, value = [], [], []
    for i in np.flatnonzero(blocks == low):
        others = np.arange(i + 1, len(blocks)) if low == high else np.flatnonzero(blocks == high)
        if not len(others):
            continue
        apart = np.abs(table[others] - table[i])
        total = (apart * apart // (table[others] + table[i])).sum(axis=1)
        if absent:
            gap = np.abs(zero[others] - zero[i])
            total += absent * (gap * gap // (zero[others] + zero[i]))
        first.extend([i] * len(others))
        second.extend(others)
        value.append(total)
    n = len(first)
    names = [sources.take(pa.array(np.array(at, np.int64))) for at in (first, second)]
    return pa.table({"lang": pa.array([cell.column("lang")[0].as_py()] * n, pa.string()), "a": names[0], "b": names[1],
                     "value": pa.array(np.concatenate(value) if value else np.empty(0, np.int64))})


def pair_divergences(groups: DataFrame, terms: DataFrame, group_block: int = GROUP_BLOCK,
                     term_block: int = TERM_BLOCK) -> DataFrame:
    """(lang, a, b, value): each pair of groups of a language once."""
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / group_block).cast("int").alias("group_blocks"),
        F.greatest(F.ceil(F.max("n_terms") / term_block), F.lit(1)).cast("int").alias("term_blocks"))
    sizes = cut(sizes, "divergence-blocks")
    block = F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int").alias("block")
    part = F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int").alias("part")
    sized = terms.join(sizes, "lang").select("lang", "source", "term", "p", "group_blocks", block, part)
    in_block = (sized.select("lang", "part", "term").distinct().groupBy("lang", "part")
                .agg(F.count(F.lit(1)).alias("in_block")))
    parts = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("part"))
    parts = parts.join(in_block, ["lang", "part"], "left")
    # One row a group and term block, so that groups without a term there take part.
    members = groups.join(sizes, "lang").select("lang", "source", F.col("zero").alias("p"), "group_blocks", block)
    markers = members.join(parts, "lang").withColumn("term", F.lit(None).cast("string"))
    slices = sized.withColumn("in_block", F.lit(None).cast("long")).unionByName(markers)
    # Each slice goes to the cells of its block with every block, itself included.
    other = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)).alias("other")
    cells = slices.select("*", other).select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                                             "part", "block", "source", "term", "p", "in_block")
    partial = cells.groupBy("lang", "low", "high", "part").applyInArrow(
        _cell, "lang string, a string, b string, value long")
    return partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(df: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, group_block: int = GROUP_BLOCK,
          term_block: int = TERM_BLOCK, **columns: str) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's distance to all other sources, and its leading terms.

    Part ``pair``: every other source of the language, by divergence.  Part
    ``term``: the group's ``top_terms`` terms with a larger share than in the
    language as a whole.  Ranks start at 1 with the largest value, equal values
    by item.
    """
    groups, terms = shares(df, min_docs, **columns)
    pairs = cut(pair_divergences(groups, terms, group_block, term_block), "divergence-pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc()))
    leading = (terms.where(F.col("p") > F.col("q"))
               .select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
               .withColumn("rank", rank).where(F.col("rank") <= top_terms))
    out = both.withColumn("rank", rank).withColumn("part", F.lit("pair")).unionByName(
        leading.withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
