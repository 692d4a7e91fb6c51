"""Territory tree, types, feature masks and person cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.functions import values
from swipeflow.session import shared_folder


def describe_territories(territories: DataFrame) -> DataFrame:
    """Type label and feature names next to the raw codes."""
    return territories.withColumns({
        "type_name": values.territory_type_name(F.col("type")),
        "features": values.decode_feature_mask(F.col("feature_mask")),
    })


def doors_only(territories: DataFrame, type: int | None = 1) -> DataFrame:
    """Territories of one type; None keeps all."""
    return territories if type is None else territories.filter(F.col("type") == type)


def territory_types(territories: DataFrame) -> DataFrame:
    """Territories per type label, most frequent first."""
    label = values.territory_type_name(F.col("type")).alias("type_name")
    return territories.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type_name")


def territory_paths(territories: DataFrame, full: bool = False, separator: str = " / ") -> DataFrame:
    """Parent name and path of every territory.

    By default the path is "parent / name" (a root is just its name). With
    ``full`` it runs from the root: known ancestors double every round, so a
    tree of depth d takes about log2(d) joins; each round is checkpointed.
    """
    parents = territories.select(
        "source_id", F.col("id").alias("parent_id"), F.col("name").alias("parent_name"),
        F.col("parent_id").alias("_up"),
    )
    paired = territories.join(parents, ["source_id", "parent_id"], "left")
    one_level = paired.withColumn("full_path", F.concat_ws(separator, "parent_name", "name"))
    if not full:
        return one_level.drop("_up")

    shared_folder(territories.sparkSession)
    base = one_level.withColumn("_path", F.col("full_path")).select(
        "source_id", "id", "_path", F.when(F.col("parent_name").isNotNull(), F.col("_up")).alias("_up")
    ).checkpoint()
    limit = base.count()
    depth = 2
    while not base.filter(F.col("_up").isNotNull()).isEmpty():
        if depth > 2 * limit:
            raise ValueError("the territory tree has a cycle")
        above = base.select(
            "source_id", F.col("id").alias("_up"), F.col("_path").alias("_head"), F.col("_up").alias("_next")
        )
        base = base.join(above, ["source_id", "_up"], "left").select(
            "source_id", "id", F.concat_ws(separator, "_head", "_path").alias("_path"),
            F.col("_next").alias("_up"),
        ).checkpoint()
        depth *= 2
    return one_level.drop("_up", "full_path").join(
        base.select("source_id", "id", F.col("_path").alias("full_path")), ["source_id", "id"], "left"
    )


def attach_cards(persons: DataFrame, cards: DataFrame) -> DataFrame:
    """Primary card (several primaries repeat the person) and all cards in input order.

    ``all_cards`` is one text cell per person, so a person's own card list is
    the unit of work by definition of the result.
    """
    primary = cards.filter(F.col("is_primary") == "true").select(
        "person_id", F.col("card_code").alias("primary_card")
    )
    listed = cards.groupBy("person_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("card_code") != "", F.struct("pos", "card_code")))).alias("c")
    ).select("person_id", F.array_join(F.col("c.card_code"), ", ").alias("all_cards"))
    return persons.join(primary, "person_id", "left").join(listed, "person_id", "left")
