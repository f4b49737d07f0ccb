"""Cancer drug cohort, regimen grouping, regimen vocabulary and regimen ingredients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oncospan.operators.ids import number_rows
from oncospan.operators.lookup import seen
from oncospan.staging import Stage

ANTINEOPLASTIC_ROOT = 21601386
# The links of a regimen to its ingredients.
INGREDIENT_LINKS = ["Has cytotoxic chemo", "Has supportive med", "Has antineoplastic"]


def cancer_drugs(drug_exposure: DataFrame, concept: DataFrame, concept_ancestor: DataFrame,
                 stage: Stage | None = None) -> DataFrame:
    """Exposures to an antineoplastic ingredient, one row per ingredient concept."""
    antineoplastic = concept_ancestor.filter(F.col("ancestor_concept_id") == ANTINEOPLASTIC_ROOT).select(
        F.col("descendant_concept_id").alias("concept_id"))
    ingredients = (concept.filter("concept_class_id = 'Ingredient'").select("concept_id", "concept_name")
                   .join(antineoplastic, "concept_id", "left_semi"))
    contents = (concept_ancestor.join(ingredients, F.col("ancestor_concept_id") == F.col("concept_id"))
                .select(F.col("descendant_concept_id").alias("_drug"), F.lower("concept_name").alias("concept_name")))
    contents = seen(contents, drug_exposure, F.col("drug_concept_id"), stage, "drugs_seen", "_drug")
    return (drug_exposure.join(contents, F.col("drug_concept_id") == F.col("_drug"))
            .select("concept_name", F.col("drug_exposure_id").alias("drug_era_id"), "person_id", "drug_concept_id",
                    F.col("drug_exposure_start_date").alias("ingredient_start_date"),
                    F.col("drug_exposure_end_date").alias("ingredient_end_date")))


def cancer_cohort(drugs: DataFrame, stage: Stage) -> DataFrame:
    """The cohort with ``rn``, a dense number of its persons."""
    persons = number_rows(drugs.select("person_id").distinct(), ["person_id"], stage, "cancer_cohort_persons", "rn")
    return drugs.join(persons, "person_id").select(
        "concept_name", "drug_era_id", "person_id", "rn", "drug_concept_id", "ingredient_start_date",
        "ingredient_end_date")


def regimen_days(drugs: DataFrame, lookback_days: int) -> DataFrame:
    """(person, day) -> first day of its regimen.

    A day joins the earliest day within the look-back, if that day is itself the earliest of its own look-back;
    otherwise the day stands alone. The windows run over distinct days, so a person's partition is bounded by the
    calendar and not by the number of exposures.
    """
    days = drugs.select("person_id", "ingredient_start_date").distinct()
    if lookback_days == 0:
        return days.withColumn("regimen_start", F.col("ingredient_start_date"))
    number = F.unix_date("ingredient_start_date")
    by_day = W.partitionBy("person_id").orderBy(number)
    earliest = F.min("ingredient_start_date").over(by_day.rangeBetween(-lookback_days, 0))
    previous = F.lag(number).over(by_day)
    alone = previous.isNull() | (previous < number - lookback_days)
    anchor = F.max(F.when(F.col("_alone"), F.col("ingredient_start_date"))).over(
        by_day.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (days.withColumns({"_earliest": earliest, "_alone": alone}).withColumn("_anchor", anchor)
            .select("person_id", "ingredient_start_date",
                    F.when(F.col("_anchor") == F.col("_earliest"), F.col("_earliest"))
                    .otherwise(F.col("ingredient_start_date")).alias("regimen_start")))


def cancer_regimen(drugs: DataFrame, lookback_days: int = 0) -> DataFrame:
    """Distinct (person, exposure, ingredient) with the start of the regimen it belongs to.

    Zero days groups drugs that start on one day; this is what the reference rule yields as written. Thirty days is
    the look-back it means.
    """
    if lookback_days == 0:  # every day is its own start, no rows need to meet
        rows = drugs.dropna(subset=["person_id", "ingredient_start_date"]).withColumn(
            "regimen_start", F.col("ingredient_start_date"))
    else:
        rows = drugs.join(regimen_days(drugs, lookback_days), ["person_id", "ingredient_start_date"])
    return rows.select("person_id", "drug_era_id", "concept_name",
                       F.col("regimen_start").alias("ingredient_start_date")).distinct()


def regimen_voc(concept: DataFrame, concept_relationship: DataFrame) -> DataFrame:
    """The best name for each ordered ingredient list: the name that spells the list, else the shortest."""
    regimens = concept.filter("vocabulary_id = 'HemOnc'").select(
        F.col("concept_id").alias("concept_id_1"), F.col("concept_name").alias("reg_name"))
    parts = concept.select(F.col("concept_id").alias("concept_id_2"), F.lower("concept_name").alias("part"))
    lists = (concept_relationship.filter(F.col("relationship_id").isin(INGREDIENT_LINKS))
             .select("concept_id_1", "concept_id_2").join(regimens, "concept_id_1").join(parts, "concept_id_2")
             .groupBy("reg_name", F.col("concept_id_1").alias("concept_id"))
             .agg(F.array_join(F.array_sort(F.collect_list("part")), ",").alias("combo_name")))
    by_list = W.partitionBy("combo_name")
    turn = F.row_number().over(by_list.orderBy(F.length("reg_name"), "reg_name", "concept_id"))
    spelled = F.lower("reg_name") == F.replace(F.col("combo_name"), F.lit(","), F.lit(" and "))
    ranked = lists.withColumn("_rank", F.when(spelled, 0).otherwise(turn))
    return (ranked.withColumn("_best", F.min("_rank").over(by_list)).filter("_rank = _best")
            .select("reg_name", "combo_name", "concept_id"))


def regimen_ingredients(drugs: DataFrame, regimen: DataFrame, voc: DataFrame,
                        distinct_ingredients: bool = False) -> DataFrame:
    """Every exposure of a regimen with the regimen's ingredient list, HemOnc concept and span.

    By default the list repeats an ingredient given twice and an exposure with k ingredients yields k * k rows, as in
    the reference. Repeats are counted before the list is built, so a list is put together from one entry per
    ingredient however many exposures there are.
    """
    eras = drugs.groupBy("person_id", "drug_era_id").agg(F.max("ingredient_end_date").alias("_end"))
    counted = (regimen.join(eras, ["person_id", "drug_era_id"])
               .groupBy("person_id", "ingredient_start_date", "concept_name")
               .agg(F.count("*").cast("int").alias("_n"), F.max("_end").alias("_end")))
    copies = F.lit(1) if distinct_ingredients else F.col("_n")
    entry = F.struct("concept_name", F.array_join(F.array_repeat("concept_name", copies), ",").alias("text"))
    groups = (counted.groupBy("person_id", F.col("ingredient_start_date").alias("regimen_start_date"))
              .agg(F.array_sort(F.collect_list(entry)).alias("_entries"), F.max("_end").alias("regimen_end_date"))
              .withColumn("_list", F.array_join(F.transform("_entries", lambda e: e["text"]), ",")))
    named = groups.join(voc.select(F.col("combo_name").alias("_list"), "reg_name",
                                   F.col("concept_id").alias("hemonc_concept_id")), "_list", "left")
    members = regimen.select("person_id", "drug_era_id", F.col("ingredient_start_date").alias("regimen_start_date"))
    contents = drugs.select("person_id", "drug_era_id", F.col("concept_name").alias("ingredient"),
                            "ingredient_start_date", "ingredient_end_date")
    return (members.join(contents, ["person_id", "drug_era_id"], "left")
            .join(named, ["person_id", "regimen_start_date"], "left")
            .select("person_id", "drug_era_id", "ingredient", "ingredient_start_date", "ingredient_end_date",
                    F.col("_list").alias("regimen"), "hemonc_concept_id", "reg_name",
                    "regimen_start_date", "regimen_end_date"))
