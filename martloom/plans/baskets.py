"""Products bought together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.numbers import ratio
from martloom.functions.text import clean_product
from martloom.plans.star import Star
from martloom.sources.staging import stage

BLOCK = 64
SHARES = (1 / 16,)  # of all lines; pairs grow with the square of what is taken


def product_spellings(star: Star) -> DataFrame:
    """(Product_Key, item, Product_Name): keys whose names clean to the same text share an item."""
    names = star.DimProduct.select("Product_Key", clean_product(F.col("Product_Name")).alias("Product_Name"))
    items = names.groupBy("Product_Name").agg(F.min("Product_Key").alias("item"))
    return names.join(items, "Product_Name").select("Product_Key", "item", "Product_Name")


def basket_items(star: Star, spellings: DataFrame) -> DataFrame:
    """Sorted distinct items per transaction.

    Sets are merged on the map side, so a repeated product, or a transaction holding a large part of
    all rows, shrinks before the shuffle; no set can outgrow the product dimension.
    """
    if star.Baskets is not None:
        known = star.Baskets.select("Transaction_ID", F.explode("Lines.Product_Key").alias("Product_Key"))
    else:
        # A line without a transaction belongs to no basket.
        known = star.FactProductBridge.filter("Transaction_ID IS NOT NULL")
    lines = known.join(spellings.select("Product_Key", "item"), "Product_Key")
    return lines.groupBy("Transaction_ID").agg(F.array_sort(F.collect_set("item")).alias("items"))


def listed_items(star: Star, spellings: DataFrame) -> DataFrame | None:
    """Items per transaction as the star keeps them, without a shuffle; nothing where keys share an item.

    Keys that no product has stay: they have no name to be shown by, and no other count depends on them.
    """
    if star.Baskets is None or not spellings.filter("Product_Key <> item").isEmpty():
        return None
    keys = F.array_except("Lines.Product_Key", F.array(F.lit(None).cast("int")))  # distinct ones, null left out
    # A line without a transaction belongs to no basket.
    return star.Baskets.filter("Transaction_ID IS NOT NULL").select("Transaction_ID", F.sort_array(keys).alias("items"))


def pair_counts(baskets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Transactions per unordered item pair (a < b); pairs are counted on the map side as they form.

    Pairs of a basket of ``block`` items or fewer form where it is read. A wider one is cut into blocks, and each
    two of its blocks, or a block with itself, are a row of their own. These rows are dealt out before pairs form,
    so the pairs of a wide basket form in many tasks, ``block`` squared at most from one row.
    """
    size = F.size("items")
    at = baskets.filter((size > 1) & (size <= block)).select("items", F.posexplode("items").alias("at", "a"))
    narrow = at.select("a", F.explode(F.slice("items", F.col("at") + 2, F.lit(block))).alias("b"))
    whole = baskets.filter((size > 1) & (size > block)).withColumn("last", F.floor((size - 1) / block).cast("int"))
    cut = lambda at: F.slice("items", F.col(at) * block + 1, F.lit(block))
    firsts = whole.select("Transaction_ID", "items", "last", F.explode(F.sequence(F.lit(0), "last")).alias("i"))
    both = firsts.select("Transaction_ID", "items", "i", F.explode(F.sequence("i", "last")).alias("j"))
    dealt = both.select("Transaction_ID", "i", "j", cut("i").alias("x"), cut("j").alias("y")).repartition(
        "Transaction_ID", "i", "j"
    )
    wide = dealt.select(F.explode("x").alias("a"), "y").select("a", F.explode("y").alias("b")).filter("a < b")
    return narrow.unionByName(wide).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _scored(pairs: DataFrame, product: DataFrame, total: Column) -> DataFrame:
    """Counted pairs with support, confidence of the first product and lift."""
    first = product.select(F.col("item").alias("a"), F.struct("Product_Name", "sold").alias("p"))
    second = product.select(F.col("item").alias("b"), F.struct("Product_Name", "sold").alias("q"))
    # The item order is arbitrary; the first product of a pair is the one first in the alphabet.
    scored = (
        pairs.join(first, "a")
        .join(second, "b")
        .select("n", F.least("p", "q").alias("p1"), F.greatest("p", "q").alias("p2"))
    )
    pair, total = F.col("n").cast("double"), total.cast("double")
    lift = (pair / F.col("p1.sold")) / (F.col("p2.sold") / total)
    return scored.select(
        F.col("p1.Product_Name").alias("Product1"),
        F.col("p2.Product_Name").alias("Product2"),
        F.col("n").alias("Pair_Trans_Count"),
        F.round(ratio(pair, total, 100.0), 2).alias("Support_Pct"),
        F.round(ratio(pair, F.col("p1.sold"), 100.0), 2).alias("Confidence_Pct"),
        F.round(lift, 2).alias("Lift"),
    )


def _best(scored: DataFrame, n: int) -> DataFrame:
    return scored.orderBy(F.desc("Lift"), "Product1", "Product2").limit(n)


def _of_rare_items(baskets: DataFrame, product: DataFrame, most: int, few: int) -> DataFrame:
    """Baskets reduced to the items, ``few`` in number, that are in ``most`` transactions or fewer.

    No more of them than a block are picked out in place; of others only their lines are shuffled.
    """
    rare = product.filter(F.col("sold") <= most).select("item")
    if few <= BLOCK:
        wanted = F.array(*[F.lit(r["item"]) for r in rare.collect()])
        return baskets.select("Transaction_ID", F.array_intersect("items", wanted).alias("items"))
    lines = baskets.select("Transaction_ID", F.explode("items").alias("item")).join(rare, "item")
    return lines.groupBy("Transaction_ID").agg(F.array_sort(F.collect_list("item")).alias("items"))


def product_pairs(star: Star, n: int = 10, block: int = BLOCK, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """The ``n`` product pairs of highest lift, with support and confidence of the first product.

    A pair is in no more transactions than either of its products, so its lift is at most the number of
    transactions over the larger of the two counts. Pairs of rare products are therefore scored first: those
    whose lines make up the first of ``shares`` of all lines, then the next. As soon as the ``n``-th lift beats
    what any pair with a more frequent product can reach, the rest is never formed; as shown, that is after
    rounding, so that no tie is lost. Otherwise all pairs are scored in the end.
    """
    # Stored first: one small row per product key, of known size for the join with the bridge.
    spellings = stage(product_spellings(star), "spellings")
    baskets = listed_items(star, spellings)
    if baskets is None:
        baskets = stage(basket_items(star, spellings), "baskets")
    if star.Baskets is not None:
        all_sales = star.Baskets.agg(F.count_if(F.size("Sales.n") > 0)).first()[0]  # reads this part of Sales only
    else:
        all_sales = star.FactSales.agg(F.countDistinct("Transaction_ID")).first()[0]
    counts = baskets.select(F.explode("items").alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("sold")
    )
    names = spellings.filter("Product_Key = item").select("item", "Product_Name")
    product = stage(counts.join(names, "item"), "products-sold")
    total = F.lit(all_sales)
    # Each wanted count weighs as many lines as it stands for: one row of numbers.
    limits = product.agg(F.percentile("sold", F.array(*[F.lit(s) for s in shares]), F.col("sold"))).first()[0] or []
    for most in sorted({int(x) for x in limits}):
        rare = F.col("sold") <= most
        next_count, few = product.agg(F.min(F.when(~rare, F.col("sold"))), F.count_if(rare)).first()
        if next_count is None:
            break
        if few * (few - 1) // 2 < n:  # too few pairs, whatever their lift
            continue
        pairs = pair_counts(_of_rare_items(baskets, product, most, few), block)
        best = stage(_best(_scored(pairs, product, total), n), "best-pairs")
        found, least, bound = best.agg(
            F.count(F.lit(1)), F.min("Lift"), F.round(total.cast("double") / F.lit(next_count), 2)
        ).first()
        if found == n and least > bound:
            return best.orderBy(F.desc("Lift"), "Product1", "Product2")
    return _best(_scored(pair_counts(baskets, block), product, total), n)
