"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks by a seeded hash of the row, so a block is a random share of its source, and a source of n
rows has about the root of n blocks of that many rows. A source's target says how many passes over all its blocks the mix
takes, and how many words of a last, partial pass. The blocks drawn from all sources are split among the output shards
by a binary tree: at each node the left half's counts are one multivariate-hypergeometric draw, so every shard gets a
random share of the blocks and the quotas add up exactly. Blocks are numbered in permuted order and each shard draws its
own interval of numbers; rows are shuffled inside their shard by hash. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import BLANKS, stage

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SHARDS = 8
SEED = 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def _uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(2.0**52)


def targets(sized: DataFrame, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, n, source_size, target`` from ``source, size``: weight shares of the total, none above its cap.

    Sources by code point, NULL last, take the weights in turn. A share above ``max_passes`` times its source is cut
    there and the rest shared anew by weight; the sources that end up cut are a prefix in order of cap over weight.
    """
    sources = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    wide = "decimal(38,0)"
    sources = sources.withColumn("weight", weight.cast(wide)).withColumn("cap", (max_passes * F.col("source_size")).cast(wide))
    everything = Window.partitionBy()
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).cast("decimal(38,10)"), F.asc_nulls_last("source"))
    earlier, later = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything).cast(wide) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)).cast(wide)
    shared = F.sum("weight").over(later).cast(wide)
    # cut if the level at which water stands among the remaining sources is above the cap
    cut = F.col("cap").cast("double") * shared.cast("double") < F.col("weight").cast("double") * left.cast("double")
    marked = sources.withColumn("cut", cut)
    total = F.sum("source_size").over(everything)
    cut_words = F.coalesce(F.sum(F.when(F.col("cut"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("cut"), F.col("weight"))).over(everything)
    level = (total.cast("double") - cut_words.cast("double")) * F.col("weight").cast("double") / open_weight.cast("double")
    return marked.select(
        "source", "n", "source_size", F.when(F.col("cut"), F.col("cap").cast("double")).otherwise(level).alias("target")
    )


def hypergeometric(population: Column, marked: Column, draws: Column, u: Column) -> Column:
    """A draw of how many of ``marked`` items are among ``draws`` taken from ``population``, by inverting ``u``.

    The support is walked from the mode up, then from the mode down, with weights relative to the mode's.
    """
    population, marked, draws = (c.cast("double") for c in (population, marked, draws))
    low = F.greatest(F.lit(0.0), draws + marked - population)
    high = F.least(marked, draws)
    mode = F.least(high, F.greatest(low, F.floor((draws + 1) * (marked + 1) / (population + 2)).cast("double")))

    def up(k: Column) -> Column:  # weight of k + 1 over weight of k
        return (marked - k) * (draws - k) / ((k + 1) * (population - marked - draws + k + 1))

    def down(k: Column) -> Column:  # weight of k - 1 over weight of k
        return k * (population - marked - draws + k) / ((marked - k + 1) * (draws - k + 1))

    def steps(count: Column) -> Column:
        return F.when(count >= 1, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))

    def start(weight, total, found) -> Column:
        return F.struct(weight.alias("k"), F.lit(1.0).alias("weight"), total.alias("total"), found.alias("found"))

    def walked(direction: int, ratio, begin: Column, count: Column, goal: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            weight = acc["weight"] * ratio(acc["k"])
            total, k = acc["total"] + weight, acc["k"] + direction
            found = F.when(acc["found"].isNull() & (total >= goal), k).otherwise(acc["found"])
            return F.struct(k.alias("k"), weight.alias("weight"), total.alias("total"), found.alias("found"))

        return F.aggregate(steps(count), begin, step)

    nothing, never = F.lit(None).cast("double"), F.lit(float("inf"))
    above = walked(1, up, start(mode, F.lit(1.0), nothing), high - mode, never)["total"]
    whole = walked(-1, down, start(mode, above, nothing), mode - low, never)["total"]
    goal = u * whole
    upward = walked(1, up, start(mode, F.lit(1.0), F.when(goal <= 1.0, mode)), high - mode, goal)
    downward = walked(-1, down, start(mode, upward["total"], upward["found"]), mode - low, goal)
    return F.coalesce(downward["found"], mode).cast("long")


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``source, shard, first, last``: the interval of block numbers [first, last) each shard draws from each source.

    ``quotas`` holds ``source, quota``. Every node of the tree is one row with its quotas as an array, so a level is a
    map; only the quotas, one per source, meet in a row.
    """
    entry = F.struct(F.col("source").isNull().alias("is_null"), "source", F.col("quota").cast("long").alias("quota"))
    nodes = quotas.agg(F.array_sort(F.collect_list(entry)).alias("quotas")).select(
        F.lit(0).alias("first_shard"), F.lit(shards).alias("n_shards"), "quotas"
    )
    kind = nodes.schema["quotas"].dataType.simpleString()
    while True:
        if nodes.where("n_shards > 1").isEmpty():
            break
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda sum_, q: sum_ + q["quota"])
        half = F.floor(F.col("n_shards") / 2).cast("int")
        # the left child's blocks: its share of the shards, in whole blocks
        left_total = F.floor(total * half / F.col("n_shards")).cast("long")

        def draw(acc: Column, q: Column) -> Column:
            u = _uniform(F.lit(str(seed)), F.col("first_shard").cast("string"), F.col("n_shards").cast("string"),
                         F.coalesce(q["source"].cast("string"), F.lit("")), q["is_null"].cast("string"))
            taken = hypergeometric(acc["population"], q["quota"], acc["draws"], u)
            return F.struct(
                (acc["population"] - q["quota"]).alias("population"),
                (acc["draws"] - taken).alias("draws"),
                F.concat(acc["left"], F.array(F.struct(q["is_null"].alias("is_null"), q["source"].alias("source"), taken.alias("quota")))).alias("left"),
            )

        begin = F.struct(total.alias("population"), left_total.alias("draws"), F.array().cast(kind).alias("left"))
        left = F.aggregate("quotas", begin, draw)["left"]
        split = nodes.where("n_shards > 1").withColumn("half", half).withColumn("left", left)
        right = F.zip_with("quotas", "left", lambda q, taken: F.struct(
            q["is_null"].alias("is_null"), q["source"].alias("source"), (q["quota"] - taken["quota"]).alias("quota")))
        children = split.select(F.explode(F.array(
            F.struct(F.col("first_shard"), F.col("half").alias("n_shards"), F.col("left").alias("quotas")),
            F.struct((F.col("first_shard") + F.col("half")).alias("first_shard"),
                     (F.col("n_shards") - F.col("half")).alias("n_shards"), right.alias("quotas")),
        )).alias("c")).select("c.*")
        nodes = stage(children.unionByName(nodes.where("n_shards = 1")), "quota-tree")
    leaves = nodes.select(F.col("first_shard").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.source", "q.quota")
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    return leaves.select("source", "shard", (upto - F.col("quota")).alias("first"), upto.alias("last"))


def draw(sized: DataFrame, shards: int = SHARDS, seed: int = SEED, weights: tuple = WEIGHTS, max_passes: int = MAX_PASSES):
    """``row, shards``: for every row of ``row, doc_id, source, size`` (and ``mark``) the shards its copies go to.

    A source's words in the mix fall short of its target by less than its smallest left-out document: whole passes, whole
    blocks of the last pass, rows of the block in which the target falls as far as they fit, the one row left that fits
    best into the rest, and further rows in permuted order until none fits.
    """
    plan = targets(sized, weights, max_passes)
    blocks_of = F.greatest(F.ceil(F.sqrt(F.col("n").cast("double"))), F.lit(1)).cast("long")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_passes))).otherwise(0)
    plan = plan.withColumn("blocks", blocks_of).withColumn("passes", whole.cast("int"))
    plan = stage(plan.withColumn("rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5).cast("long")), "mix-plan")

    # rows without id are told apart by their text, or they would all lie in one block
    mark = F.col("d.mark") if "mark" in sized.columns else F.lit("")
    named, unnamed = (_uniform(F.lit(str(seed)), part) for part in (F.col("d.doc_id").cast("string"), F.concat(F.lit("|"), mark)))
    place = F.when(F.col("d.doc_id").isNotNull(), named).otherwise(unnamed)
    here = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    placed = stage(
        here.select("d.row", "d.source", "d.size", place.alias("place"), "p.rest", "p.passes", "p.blocks")
        .withColumn("block", F.floor(F.col("place") * F.col("blocks")).cast("long"))
        .select("row", "source", "size", "place", "block"),
        "mix-rows",
    )
    words = placed.groupBy("source", "block").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("b.source").orderBy("b.block")
    upto = F.sum("b.words").over(in_order)
    blocks = (
        words.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source")))
        .select("b.source", "b.block", (upto - F.col("b.words")).alias("before"), upto.alias("upto"), "p.rest", "p.passes", "p.blocks")
    )
    blocks = blocks.withColumn("full", (F.col("rest") > 0) & (F.col("upto") <= F.col("rest")))
    blocks = stage(blocks.withColumn("edge", (F.col("before") < F.col("rest")) & (F.col("rest") < F.col("upto"))), "mix-blocks")

    # the block in which the target falls: its rows in permuted order as far as they fit
    edge = blocks.where("edge").select("source", "block", (F.col("rest") - F.col("before")).alias("room"))
    inside = placed.alias("d").join(
        edge.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.block") == F.col("e.block"))
    ).select("d.*", "e.room")
    filled = F.sum("size").over(Window.partitionBy("source", "block").orderBy("place", "row"))
    inside = stage(inside.withColumn("fits", filled <= F.col("room")).withColumn("filled", filled), "mix-edge")
    gap = inside.groupBy("source").agg(
        F.min(F.col("room") - F.when(F.col("fits"), F.col("filled")).otherwise(0)).alias("gap")
    )
    # of the rows the partial pass leaves out, the largest that fits into what is missing
    out = blocks.where("not full").select("source", "block", "edge")
    candidates = placed.alias("d").join(
        out.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.block") == F.col("o.block"))
    ).join(gap.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).where("d.size <= g.gap and d.size > 0")
    fitting = candidates.join(
        inside.where("fits").select(F.col("row").alias("in_row")), F.col("d.row") == F.col("in_row"), "left_anti"
    )
    fitting = fitting.select("d.source", "d.block", "d.row", "d.size", "d.place", "g.gap")
    largest = F.max(F.struct("size", "place", "row")).alias("best")
    best = stage(fitting.groupBy("source").agg(largest).select("source", "best.row", "best.size"), "mix-best")
    extra = inside.where("fits").select("row").unionByName(best.select("row"))
    others = fitting.alias("d").join(F.broadcast(best.alias("b")), F.col("d.source").eqNullSafe(F.col("b.source"))).where("d.row <> b.row")
    pool = others.select("d.source", "d.block", "d.row", "d.size", "d.place", (F.col("d.gap") - F.col("b.size")).alias("gap"))
    pool = stage(pool.where("size <= gap"), "mix-pool")
    # where a long row ended the filling, left-out rows that still fit are drawn in permuted order, until none fits
    while not pool.isEmpty():
        words = pool.groupBy("source", "block").agg(F.sum("size").alias("words"))
        before = F.sum("words").over(Window.partitionBy("source").orderBy("block")) - F.col("words")
        begun = words.select("source", "block", before.alias("before"))
        same = F.col("d.source").eqNullSafe(F.col("w.source")) & (F.col("d.block") == F.col("w.block"))
        filled = F.col("before") + F.sum("size").over(Window.partitionBy("source", "block").orderBy("place", "row"))
        drawn = pool.alias("d").join(begun.alias("w"), same).select("d.*", "w.before").withColumn("filled", filled).drop("before")
        drawn = stage(drawn.withColumn("fits", F.col("filled") <= F.col("gap")), "mix-fill")
        extra = extra.unionByName(drawn.where("fits").select("row"))
        spent = drawn.where("fits").groupBy("source").agg(F.max("filled").alias("spent"))
        left = drawn.where("not fits").alias("d").join(F.broadcast(spent.alias("s")), F.col("d.source").eqNullSafe(F.col("s.source")))
        left = left.select("d.source", "d.block", "d.row", "d.size", "d.place", (F.col("d.gap") - F.col("s.spent")).alias("gap"))
        pool = stage(left.where("size <= gap"), "mix-pool")
    extra = stage(extra, "mix-extra")

    # numbers of the drawn blocks: pass by pass in permuted order; the edge block is the last one
    partial = F.col("full") | F.col("edge")
    drawn = blocks.where(partial).groupBy("source").agg(F.max("block").alias("last_block"))
    quota = plan.alias("p").join(drawn.alias("x"), F.col("p.source").eqNullSafe(F.col("x.source")), "left").select(
        "p.source", (F.col("p.passes") * F.col("p.blocks") + F.coalesce(F.col("x.last_block") + 1, F.lit(0))).alias("quota")
    )
    leaves = split_quotas(quota, shards, seed)
    numbered = blocks.select(
        "source", "block", F.explode(F.expr("sequence(0, passes)")).alias("pass"), "blocks"
    ).withColumn("number", F.col("pass") * F.col("blocks") + F.col("block"))
    dealt = numbered.alias("b").join(
        leaves.alias("l"),
        F.col("b.source").eqNullSafe(F.col("l.source")) & (F.col("b.number") >= F.col("l.first")) & (F.col("b.number") < F.col("l.last")),
    )
    entry = F.struct(F.col("b.pass").alias("pass"), F.col("l.shard").alias("shard"))
    by_block = dealt.groupBy("b.source", "b.block").agg(F.array_sort(F.collect_list(entry)).alias("dealt"))
    full = blocks.select("source", "block", "full", "passes")
    lot = stage(
        full.alias("f").join(
            by_block.alias("y"), F.col("f.source").eqNullSafe(F.col("y.source")) & (F.col("f.block") == F.col("y.block")), "left"
        ).select("f.source", "f.block", "f.full", "f.passes", F.coalesce("y.dealt", F.array().cast("array<struct<pass:int,shard:int>>")).alias("dealt")),
        "mix-lots",
    )
    chosen = (
        placed.alias("d")
        .join(lot.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.block") == F.col("o.block")))
        .join(extra.alias("x"), F.col("d.row") == F.col("x.row"), "left")
    )
    whole_passes = F.transform(F.filter("o.dealt", lambda e: e["pass"] < F.col("o.passes")), lambda e: e["shard"])
    last_shard = F.element_at(F.transform("o.dealt", lambda e: e["shard"]), -1)
    # a row that only fills the rest goes where its block went, or to a shard its place names
    spare = F.coalesce(F.when(F.col("o.passes") < F.size("o.dealt"), last_shard), F.floor(F.col("d.place") * 1e6 % shards).cast("int"))
    one_more = F.col("o.full") | F.col("x.row").isNotNull()
    copies = F.when(one_more, F.concat(whole_passes, F.array(spare))).otherwise(whole_passes)
    return chosen.select("d.row", copies.alias("shards"))


def sized_rows(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``doc, row, doc_id, mark, source, size`` of every row; numbers of rows hold once they are staged.

    ``mark`` is a digest of the text where there is no id.
    """
    return docs.select(
        F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"), F.when(F.col(id_col).isNull(), F.md5(F.coalesce(text_col, F.lit("")))).alias("mark"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
    )


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    weights: tuple = WEIGHTS,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """Per row ``doc_id, size, source_size, target, taken, shards``: what the mix takes of it.

    Size counts words; a NULL or empty text has none and is drawn without changing any figure. Rows without source are
    a source of their own that sorts last. Very long texts count like any other. Repeated rows are drawn each on their own. ``taken`` is the size times the
    number of copies, at most ``max_passes``. The same table, seed and number of shards give the same mix.
    """
    sized = stage(sized_rows(docs, id_col, source_col, text_col).drop("doc"), "mix-sizes")
    drawn = draw(sized, shards, seed, weights, max_passes)
    plan = targets(sized, weights, max_passes)
    return (
        sized.alias("s").join(drawn.alias("w"), F.col("s.row") == F.col("w.row"))
        .join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        .select("s.doc_id", "s.size", "p.source_size", "p.target",
                (F.col("s.size") * F.size("w.shards")).cast("long").alias("taken"), "w.shards")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    weights: tuple = WEIGHTS,
    max_passes: int = MAX_PASSES,
) -> DataFrame:
    """``shard, doc``: the mix itself, every copy of a drawn row as a struct, each shard together and in random order."""
    rows = stage(sized_rows(docs, id_col, source_col, text_col), "mix-documents")
    drawn = draw(rows.drop("doc"), shards, seed, weights, max_passes).where(F.size("shards") > 0)
    copies = rows.alias("d").join(drawn.alias("w").hint("shuffle_hash"), F.col("d.row") == F.col("w.row"))
    copies = copies.select(F.posexplode("w.shards").alias("copy", "shard"), "d.row", "d.doc")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "row", "copy"))
    return copies.withColumn("_order", order).repartitionByRange("shard", "_order").sortWithinPartitions("shard", "_order").select("shard", "doc")
