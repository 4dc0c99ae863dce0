"""Mixing sources to target weights, in DataFrame functions only.

1. *Targets*: one row per source; the budget is poured over the sources by
   weight until each stands at its share or at its cap (water-filling, solved
   in closed form over the sorted cap/weight ratios).
2. *Blocks*: the words of a source, its documents in a fixed pseudorandom
   order, are cut into blocks of ``block_words``.  A block is known by
   (source, index); documents know the blocks they lie in from a two-level
   prefix sum, so that no source has to pass through one task.
3. *Slots*: a source gets as many slots as its target has blocks, a first
   pass over its blocks and, above its size, further ones.  A pseudorandom
   permutation of all slots deals them to output shards: the source counts of
   a shard are multinomial, conditioned on the totals, so targets are met.
4. Slot ``j`` of a pass takes block ``permute(j)`` of its source; slots and
   document pieces meet in one join by (source, block).
5. *Order*: ``mixed_blocks`` gives the blocks by (shard, position), and
   ``mixed_documents`` the documents by the place of their first word's block;
   a partition holds whole shards, one after the other.  What ``mix`` takes of
   a document does not depend on the draw.

Nulls: a null source is a source of its own, ranked last; null or empty texts
have size 0 and are kept with nothing taken; a null ``doc_id`` is kept.
Repeated rows are separate documents, also those of one ``doc_id``, which are
dealt to parts of the prefix sum by their texts.  A very long text is cut in one
row, into blocks as any other.  An empty table gives an empty result.
Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowline.llm.common import SPACE_PATTERN, WORD_PATTERN, staged, table
from flowline.operators.ranking import default_partitions

WEIGHTS = (5, 2, 1)
PERCENT = 150        # words of the mix, in percent of all words
CAP = 2              # a source (and a document) is taken at most so often
BLOCK_WORDS = 64
DIGITS = 3           # hexadecimal digits that make a bucket: 4,096 parts of a source's prefix sum
SHARD_SLOTS = 1024   # blocks of an output shard
PART_SLOTS = 262_144 # slots of an output partition, about 100 MB of text
SEQUENCE = 16_384    # slots made from one row
TASK_SLOTS = 1 << 20 # slots made in one task
ROUNDS = 24          # of the permutation
PRIME, PRIME_2 = 2_147_483_647, 2_147_483_629


def _turn_sql(r: str, n: str, key: str) -> str:
    """SQL (of Spark and of DuckDB) for the constant of round ``r``."""
    return f"(((({key} + {r} * 104729) * 69621) % {PRIME}) * 40503) % {n}"


def _swap_sql(v: str, turn: str, n: str) -> str:
    """SQL (of Spark and of DuckDB) for a round of a swap-or-not shuffle of
    0..n-1: v and its partner turn - v change places if a hash of the larger
    of the two says so, which makes each round a bijection for any n."""
    partner = f"(({turn} + {n} - {v}) % {n})"
    high = f"greatest({v}, {partner})"
    bits = (f"((({high} % {PRIME}) * 1103515245 + ({high} % {PRIME_2}) * 69069 + {turn}) % {PRIME})"
            f" * 1566083941 % {PRIME}")
    return f"CASE WHEN ({bits}) % 1024 < 512 THEN {partner} ELSE {v} END"


def turns(n: str, key: str) -> Column:
    """The constants of all rounds for a permutation of 0..n-1."""
    return F.expr(f"transform(sequence(1L, {ROUNDS}L), r -> {_turn_sql('r', n, key)})")


def permute(x: str, n: str, turns_col: str) -> Column:
    """A pseudorandom permutation of 0..n-1 at ``x``."""
    return F.expr(f"aggregate({turns_col}, {x}, (v, turn) -> {_swap_sql('v', 'turn', n)})")


def sized(docs: DataFrame, *carry: str) -> DataFrame:
    """Words and place of each document; ``uid`` tells repeated rows apart."""
    text = F.coalesce("text", F.lit(""))
    return staged(docs.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "source",
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint").alias("size"),
        F.xxhash64(text).alias("tie"),
        # by text as well: one doc_id may hold a third of all rows
        F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "),
                                          F.md5(text))), 1, DIGITS), 16, 10)
         .cast("bigint").alias("bucket"), *carry), "mixing_sizes")


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT, cap: int = CAP) -> DataFrame:
    """(source, src, source_size, target): one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("src") % len(weights)) + 1).cast("int"))
    order = Window.orderBy("ratio", "src")
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    all_sources = Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding,
                                                             Window.unboundedFollowing)
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("src", (F.row_number().over(by_name) - 1).cast("bigint"))
         .withColumn("weight", weight)
         .withColumn("most", F.col("source_size") * cap)
         .withColumn("ratio", F.col("most") / F.col("weight"))
         .withColumn("budget", F.sum("source_size").over(all_sources) * (percent / 100))
         .withColumn("level", (F.col("budget") - before) / left)
         .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "src", "level")))
                     .over(all_sources)["level"]))
    return s.select("source", "src", "source_size",
                    F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _passes(targets: DataFrame, cap: int, block_words: int) -> DataFrame:
    """``targets`` by pass: its words, slots (n) and the source's blocks."""
    want = F.round("target").cast("bigint")
    return (targets.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
            .withColumn("words", F.greatest(F.lit(0), F.least("source_size",
                                                              want - F.col("pass") * F.col("source_size"))))
            .withColumn("n", F.ceil(F.col("words") / block_words).cast("bigint"))
            .withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("bigint")))


def _parts(targets: DataFrame, cap: int, block_words: int, each: int) -> int:
    """Partitions that hold ``each`` slots of the mix, the session's number at
    least: AQE doesn't split partitions of a given number."""
    total = _passes(targets, cap, block_words).agg(F.sum("n")).first()[0] or 0
    return max(default_partitions(targets.sparkSession), -(-int(total) // each))


def slots(targets: DataFrame, cap: int = CAP, block_words: int = BLOCK_WORDS,
          shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, shards, position, src, pass, block, words): the blocks of the mix.
    Counting its rows by (shard, src) gives the multinomial draw."""
    per_pass = _passes(targets, cap, block_words)
    order = Window.orderBy("src", "pass")
    per_pass = (per_pass
                .withColumn("base", F.sum("n").over(order) - F.col("n"))
                .withColumn("total", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding,
                                                                       Window.unboundedFollowing)))
                .filter("n > 0"))
    # the rounds' constants once per source and pass, not once per slot
    per_pass = (per_pass.withColumn("key", (F.col("src") * 7919 + F.col("pass") * 104_729 + 12_345) % PRIME)
                .withColumn("own_turns", turns("blocks", "key"))
                .withColumn("all_turns", turns("total", "CAST(777 AS BIGINT)")))
    # an explicit count: AQE would join these few rows, each thousands of slots, to one task
    rows = (per_pass.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1,
                                                             F.lit(SEQUENCE).cast("bigint"))))
            .repartition(_parts(targets, cap, block_words, TASK_SLOTS), "src", "pass", "from")
            .withColumn("j", F.explode(F.sequence("from", F.least(F.col("from") + SEQUENCE, F.col("n")) - 1))))
    return (rows.withColumn("global", F.col("base") + F.col("j"))
            .select(permute("global", "total", "all_turns").alias("position"),
                    "src", "pass", permute("j", "blocks", "own_turns").alias("block"),
                    F.when(F.col("words") == F.col("source_size"), block_words)   # a whole pass
                     .otherwise(F.least(F.lit(block_words), F.col("words") - F.col("j") * block_words))
                     .cast("bigint").alias("words"),
                    F.ceil(F.col("total") / shard_slots).cast("bigint").alias("shards"))
            .withColumn("shard", F.floor(F.col("position") / shard_slots).cast("bigint")))


def placed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``sizes`` with src, source_size, target and the document's first word
    in its source: the sum within its bucket plus that of earlier buckets."""
    names = targets.select(F.col("source").alias("_source"), "src", "source_size", "target")
    d = sizes.join(names, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    inside = Window.partitionBy("src", "bucket").orderBy(F.col("doc_id").asc_nulls_first(), "tie", "uid")
    earlier = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (d.groupBy("src", "bucket").agg(F.sum("size").alias("_sum"))
            .select("src", "bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")))
    return (d.withColumn("_in", F.sum("size").over(inside) - F.col("size"))
            .join(sums, ["src", "bucket"])
            .withColumn("start", F.col("_base") + F.col("_in")).drop("_in", "_base"))


def taken_pieces(docs: DataFrame, takes: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(uid, pass, begin, words, lo, shard, shards, position): the runs of each
    document that slots take, with their place in the mix; ``lo`` is the first
    word's index in its block."""
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    pieces = (docs.filter("size > 0").select("uid", "src", "start", "size",
                                             F.explode(F.sequence(first, last)).alias("block"))
              .withColumn("lo", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
              .withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block") * block_words,
                                        F.lit(block_words)))
              .withColumn("begin", F.col("block") * block_words + F.col("lo") - F.col("start"))
              .drop("start", "size"))
    # slots come out of an explode, whose size no estimate sees: never broadcast them
    hit = pieces.join(takes.select("src", "pass", "block", "words", "shard", "shards", "position").hint("merge"),
                      ["src", "block"])
    return (hit.withColumn("words", F.least("hi", "words") - F.col("lo")).filter("words > 0")
            .select("uid", "pass", "begin", "words", "lo", "shard", "shards", "position"))


def by_shard(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """``rows`` with whole shards in each of ``n`` partitions, in the order of
    shards, and sorted by ``order`` within it."""
    return (rows.repartitionById(n, F.floor(F.col("shard") * n / F.col("shards")).cast("int"))
            .sortWithinPartitions(*order))


def mix(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, cap: int = CAP,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each
    document."""
    sizes = sized(docs)
    targets = staged(source_targets(sizes, weights, percent, cap), "mixing_targets")
    d = staged(placed(sizes, targets), "mixing_places")
    taken = (taken_pieces(d, slots(targets, cap, block_words), block_words)
             .groupBy("uid").agg(F.sum("words").alias("taken")))
    return (d.join(taken.hint("merge"), "uid", "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")))


def _words(text: str) -> Column:
    return F.split(F.trim(F.regexp_replace(text, SPACE_PATTERN, " ")), " ")


def mixed_blocks(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, cap: int = CAP,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, position, source, words, text, pieces: the mix as blocks, by
    (shard, position); their counts by (shard, source) are the draw.  The text
    is the words joined by one space; ``pieces`` are the documents they come
    from, in order: doc_id, first word and number of words."""
    sizes = sized(docs, "text")
    slim = sizes.drop("text")
    targets = staged(source_targets(slim, weights, percent, cap), "mixing_targets")
    taken = (taken_pieces(placed(slim, targets), slots(targets, cap, block_words, shard_slots), block_words)
             .groupBy("uid").agg(F.collect_list(F.struct("shard", "shards", "position", "lo", "begin", "words"))
                                 .alias("_runs")))
    # the words are bound once per row, as in mixed_documents
    cut = F.element_at(F.transform(F.array(_words("text")), lambda w: F.transform("_runs", lambda r: F.struct(
        r["shard"].alias("shard"), r["shards"].alias("shards"), r["position"].alias("position"),
        r["lo"].alias("lo"), r["begin"].alias("begin"), r["words"].alias("words"),
        F.array_join(F.slice(w, (r["begin"] + 1).cast("int"), r["words"].cast("int")), " ").alias("text")))), 1)
    runs = (sizes.join(taken.hint("merge"), "uid").select("doc_id", "source", F.explode(cut).alias("r"))
            .select("doc_id", "source", "r.*"))
    blocks = (runs.groupBy("shard", "shards", "position", "source")
              .agg(F.sort_array(F.collect_list(F.struct("lo", "doc_id", "begin", "words", "text"))).alias("_p")))
    return by_shard(blocks, _parts(targets, cap, block_words, PART_SLOTS), "position").select(
        "shard", "position", "source", F.expr("aggregate(_p.words, 0L, (a, w) -> a + w)").alias("words"),
        F.array_join("_p.text", " ").alias("text"),
        F.transform("_p", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["begin"].alias("begin"),
                                             p["words"].alias("words"))).alias("pieces"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, cap: int = CAP,
                    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: one row for each
    pass that takes words of a document, by shard, in the order of the blocks
    that hold their first words.  A pass that takes all of it keeps
    the text as it is; else the text is the taken words joined by one space.
    ``n_chars`` follows the text.  Documents without words are not in a mix."""
    from pyspark.sql.types import StructType

    sizes = sized(docs, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    slim = sizes.drop("row")
    targets = staged(source_targets(slim, weights, percent, cap), "mixing_targets")
    d = placed(slim, targets)
    place = F.struct("begin", "words", "shard", "shards", "position", "lo")
    runs = (taken_pieces(d, slots(targets, cap, block_words, shard_slots), block_words)
            .groupBy("uid", "pass").agg(F.sum("words").alias("_n"),
                                        F.sort_array(F.collect_list(place)).alias("_runs")))
    words = _words("row.text")
    # the words are bound once per row: in the inner lambda they would be cut anew for every run
    part = F.element_at(F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(
        "_runs", lambda r: F.slice(w, (r["begin"] + 1).cast("int"), r["words"].cast("int")))), " ")), 1)
    text = F.when(F.col("_n") == F.col("size"), F.col("row.text")).otherwise(part)
    schema: StructType = docs.schema
    rows = by_shard(sizes.join(runs.hint("merge"), "uid").withColumn("_first", F.col("_runs")[0])
                    .select("row", text.alias("_text"), "_first.shard", "_first.shards", "_first.position", "_first.lo"),
                    _parts(targets, cap, block_words, PART_SLOTS), "position", "lo")
    return rows.select(*[F.col("_text").alias(f.name) if f.name == "text"
                         else F.length("_text").cast(f.dataType).alias(f.name) if f.name == "n_chars"
                         else F.col("row").getField(f.name).alias(f.name) for f in schema])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to weights 5, 2, 1 with 150 % of their words."""
    return mix(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same mix for DuckDB."""
    b = BLOCK_WORDS
    return f"""
WITH sizes AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || md5(coalesce(text, ''))),
                             1, {DIGITS}) AS BIGINT) AS bucket
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
  FROM sizes GROUP BY source),
caps AS (
  SELECT *, CASE src % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * {CAP} AS most
  FROM named),
ratios AS (SELECT *, CAST(most AS DOUBLE) / weight AS ratio FROM caps),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * {PERCENT / 100}
             - coalesce(sum(most) OVER (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ratios),
chosen AS (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, src LIMIT 1),
targets AS (
  SELECT source, src, source_size, least(CAST(most AS DOUBLE), (SELECT level FROM chosen) * weight) AS target
  FROM levels),
passes AS (
  SELECT t.*, p.pass, CAST(ceil(source_size / {float(b)}) AS BIGINT) AS blocks,
         greatest(0, least(source_size, CAST(round(target) AS BIGINT) - p.pass * source_size)) AS words
  FROM targets t, (SELECT unnest(range({CAP})) AS pass) p),
counted AS (
  SELECT *, CAST(ceil(words / {float(b)}) AS BIGINT) AS n,
         CAST((src * 7919 + pass * 104729 + 12345) % {PRIME} AS BIGINT) AS key FROM passes),
drawn AS (SELECT *, unnest(range(n)) AS j FROM counted WHERE n > 0),
takes AS (
  SELECT src, CASE WHEN words = source_size THEN {b} ELSE least({b}, words - j * {b}) END AS words,
         list_reduce([j] || range(1, {ROUNDS + 1}),
                     lambda v, r: {_swap_sql('v', '(' + _turn_sql('r', 'blocks', 'key') + ')', 'blocks')}) AS block
  FROM drawn),
places AS (
  SELECT doc_id, size, t.src, source_size, target,
         CAST(sum(size) OVER (PARTITION BY t.src ORDER BY bucket, doc_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - size AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT *, unnest(range(start // {b}, (start + size - 1) // {b} + 1)) AS block
  FROM places WHERE size > 0),
hits AS (
  SELECT doc_id, greatest(0, least(start + size - p.block * {b}, {b}, words) - greatest(start - p.block * {b}, 0)) AS got
  FROM pieces p JOIN takes k ON p.src = k.src AND p.block = k.block),
sums AS (SELECT doc_id, sum(got) AS taken FROM hits GROUP BY doc_id)
SELECT p.doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM places p LEFT JOIN sums USING (doc_id)
"""
