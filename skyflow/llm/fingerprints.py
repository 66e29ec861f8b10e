"""Document fingerprints: a Merkle tree over sections, paragraphs and short stretches of words; built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# up to seven words that don't end a sentence and that another word follows, and one more word, with the white space around them
_STRETCH = r"\s*+(?:\S++(?<![.!?])\s++(?=\S)){0,7}+\S++\s*+"
ROWS_PER_RANGE = 4_000      # neighbouring documents that one window group holds
_MAX_RANGES = 2_000         # ranges whose bounds are looked up; beyond this many the ranges grow


def stretches_of(line: Column) -> Column:
    """The stretches of a line, which joined are the line; a line without words is a stretch itself."""
    found = F.regexp_extract_all(line, F.lit(_STRETCH), F.lit(0))
    return F.when(F.size(found) > 0, found).otherwise(F.array(line))


def leaves_of(text: Column) -> Column:
    """The leaf hashes of a text, section by section and paragraph by paragraph: array<array<array<bigint>>>. Sections end
    at an empty line, paragraphs at a line break; a paragraph without words is a leaf itself."""
    leaves = lambda line: F.transform(stretches_of(line), lambda x: F.xxhash64(x))
    return F.transform(F.split(text, "\n\n", -1), lambda section: F.transform(F.split(section, "\n", -1), leaves))


def merkle(leaves: Column) -> Column:
    """struct(root, sections array<struct(hash, paragraphs array<string>)>) of nested leaf hashes: every node is the SHA-256 of
    its children's hashes."""
    paragraphs = lambda section: F.transform(section, lambda p: F.sha2(F.array_join(F.transform(p, F.hex), ","), 256))
    sections = F.transform(leaves, lambda s: F.struct(
        F.sha2(F.array_join(paragraphs(s), ","), 256).alias("hash"), paragraphs(s).alias("paragraphs")))
    root = F.sha2(F.array_join(F.transform(sections, lambda s: s["hash"]), ","), 256)
    return F.struct(root.alias("root"), sections.alias("sections"))


def root_of(leaves: Column) -> Column:
    paragraph = lambda p: F.sha2(F.array_join(F.transform(p, F.hex), ","), 256)
    section = lambda s: F.sha2(F.array_join(F.transform(s, paragraph), ","), 256)
    return F.sha2(F.array_join(F.transform(leaves, section), ","), 256)


def _flat(leaves: Column) -> Column:
    return F.array_distinct(F.flatten(F.flatten(leaves)))


def fingerprint_of(root: Column, leaves: Column) -> Column:
    """root, a colon, and the low 32 bits of the distinct leaves, 8 hex digits each, in the order of the text."""
    short = F.transform(leaves, lambda h: F.substring(F.lpad(F.hex(h), 16, "0"), 9, 8))
    return F.concat(root, F.lit(":"), F.array_join(short, ""))


def likeness(a: Column, b: Column) -> Column:
    """Twice the leaves that both trees have to the leaves of both: 1 for equal trees, 0 for trees without a common leaf."""
    return F.size(F.array_intersect(a, b)) * 2.0 / (F.size(a) + F.size(b))


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """
    `id_column` and the whole tree of each text: root, sections (hash, paragraphs) and leaves, so that equal roots show equal
    texts and the places where two trees differ locate an edit (`differing_branches`).

    Null texts are empty (a tree with one empty leaf); null ids and repeated rows keep their row; other columns are not
    read; an empty table gives an empty table. Nothing is shuffled.
    """
    leaves = leaves_of(F.coalesce(F.col(text_column), F.lit("")))
    rows = docs.select(F.col(id_column), leaves.alias("leaves"))
    return rows.withColumn("_tree", merkle(F.col("leaves"))).select(id_column, "_tree.root", "_tree.sections", "leaves")


def differing_branches(a: DataFrame, b: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Where the trees of the same id differ: id, section and paragraph (from 0), the two paragraph hashes (null: absent).
    Only trees with different roots and, in them, sections with different hashes are opened. Ids should be unique; null ids match none."""
    pairs = a.alias("a").join(b.alias("b"), id_column).filter(F.col("a.root") != F.col("b.root"))
    empty = F.array().cast("array<string>")
    sections = pairs.select(id_column, F.posexplode(F.arrays_zip(F.col("a.sections").alias("x"), F.col("b.sections").alias("y"))).alias("section", "_s"))
    changed = sections.filter(~F.col("_s.x.hash").eqNullSafe(F.col("_s.y.hash")))
    paragraphs = changed.select(id_column, "section", F.posexplode(F.arrays_zip(
        F.coalesce("_s.x.paragraphs", empty).alias("x"), F.coalesce("_s.y.paragraphs", empty).alias("y"))).alias("paragraph", "_p"))
    return paragraphs.filter(~F.col("_p.x").eqNullSafe(F.col("_p.y"))).select(
        id_column, "section", "paragraph", F.col("_p.x").alias("hash_a"), F.col("_p.y").alias("hash_b"))


def with_next(docs: DataFrame, columns: list[str], id_column: str = "doc_id", tie: str = "_tie") -> DataFrame:
    """
    `docs` plus next_<column> for each of `columns`: those of the next row in descending (`id_column`, `tie`), after the
    last row those of the first; null ids come last. Rows are dealt into ranges of ids and looked ahead within each; a range's last row takes
    the first row of the next range, of which there is one for each range.
    """
    n = docs.count()
    ranges = max(1, min(_MAX_RANGES, n // ROWS_PER_RANGE))
    bounds = docs.agg(F.percentile_approx(id_column, [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] if ranges > 1 else []
    edges = sorted(set(bounds or []))
    # range 0 has the highest ids; null ids are the last range
    place = F.lit(len(edges)) - F.when(F.col(id_column).isNull(), -1).otherwise(
        F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(id_column))) if edges else F.lit(0))
    order = [F.col(id_column).desc_nulls_last(), F.col(tie).desc()]
    rows = docs.withColumn("_range", place.cast("int"))
    within = Window.partitionBy("_range").orderBy(*order)
    ahead = rows.withColumn("_next", F.lead(F.struct(*columns)).over(within))
    # the first row of each range: map-side maximum, one row per range
    firsts = rows.groupBy("_range").agg(F.max_by(F.struct(*columns), F.struct(F.coalesce(id_column, F.lit(-(1 << 63))), tie)).alias("_first"))
    present = sorted(r["_range"] for r in firsts.select("_range").collect())      # at most _MAX_RANGES + 2
    follows = docs.sparkSession.createDataFrame(
        [(a, b) for a, b in zip(present, present[1:] + present[:1])] or [(0, 0)], "_range int, _following int")
    heads = follows.join(firsts.withColumnRenamed("_range", "_following"), "_following").select("_range", "_first")
    last = ahead.filter("_next IS NULL").join(heads, "_range").withColumn("_next", F.col("_first")).drop("_first")
    both = ahead.filter("_next IS NOT NULL").unionByName(last)
    return both.select(*docs.columns, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of an edited text, and how near they are to each other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("_tie", F.xxhash64("text")), ["text"])
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.length("text") - half
    rows = rows.select(
        "doc_id", "text", "next_text",
        F.concat(F.col("text").substr(F.lit(1), kept), F.col("next_text").substr(F.lit(1), half)).alias("edited"))
    trees = rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        leaves_of(F.col("text")).alias("_own"), leaves_of(F.col("edited")).alias("_edited"), leaves_of(F.col("next_text")).alias("_next"))
    flat = trees.select(
        "doc_id", "n_chars", "edited_sha256", root_of(F.col("_own")).alias("_root"), root_of(F.col("_edited")).alias("_edited_root"),
        _flat(F.col("_own")).alias("_own"), _flat(F.col("_edited")).alias("_edited"), _flat(F.col("_next")).alias("_next"))
    return flat.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint_of(F.col("_root"), F.col("_own")).alias("fingerprint"),
        fingerprint_of(F.col("_edited_root"), F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"), likeness(F.col("_own"), F.col("_next")).alias("near_next"))
