"""Ad-hoc listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow import config as C
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators.aggregates import distinct_count_by
from placaflow.operators.joins import BRAND, lookup, scope_of, zero_fill
from placaflow.operators.ordering import order_rows
from placaflow.operators.sets import constant_rows
from placaflow.plans.base import (
    PLATE_REFERENCE,
    Tables,
    benefit_lookup,
    bridged_coverages,
    bridged_trailers,
    contract_base,
    contract_sets,
    coverages,
    sets_with_coverages,
    steps_over,
    unit_lookup,
    vehicle_or_trailer,
)


def master_listing(tables: Tables) -> DataFrame:
    """Every coverage with a plate and a chassis, whatever its status.

    In steps the narrow rows of the coverages get their plates and benefits first. Rows of sets
    and those of coverages are made distinct before they meet: as the listing has all columns of
    both, it then holds no row twice.
    """
    steps = steps_over(tables)
    day = X.ticks_to_timestamp(F.col("updated_at"))  # different ticks of one day are equal here
    if steps.on:
        by = ["set_id", "coverage_id"]
        rows = vehicle_or_trailer(bridged_coverages(tables, None, steps), tables, by=by, steps=steps)
        rows = rows.where(P.identity_not_null(F.col("placa"), F.col("chassi")))
        rows = steps.cut(rows.drop(*PLATE_REFERENCE), "plates")
        rows = benefit_lookup(rows, tables, by).withColumn("data_atualizacao", day)
        rows = steps.cut(rows.drop("id_price_list", "updated_at"), "benefits")
        rows = steps.cut(rows.distinct(), "coverages")
        sets = contract_sets(tables)
        of_set = ("conjunto", "matricula", "status", "inicio_vig", "data_registro", "conjunto_renovado")
        rows = sets_with_coverages(sets.select(*scope_of(sets), *of_set).distinct(), rows)
    else:
        rows = benefit_lookup(contract_base(tables), tables).withColumn("data_atualizacao", day)
    listing = rows.select(
        F.col("coverage_id").alias("coverage"),
        "beneficio",
        "placa",
        "chassi",
        "id_placa",
        "matricula",
        "conjunto",
        "status",
        F.col("inicio_vig").alias("data_ativacao"),
        "data_registro",
        F.col("conjunto_renovado").alias("id_renovacao"),
        "data_ativacao_beneficio",
        "data_atualizacao",
        "status_beneficio",
        BRAND,
    )
    # Rows of several days or spans, which are no columns of the listing, may be equal.
    return listing if steps.on and scope_of(rows) == [BRAND] else listing.distinct()


def cancelled_plates_by_unit(tables: Tables, day: dt.date, ordered: bool = True) -> DataFrame:
    """Distinct plates of sets cancelled on a day, per unit and brand (direct trailers
    do not count). Units whose sets have no plate show 0."""
    sets = contract_sets(tables, P.exact_date(F.col("date_cancellation"), day))
    sets = unit_lookup(
        sets, tables, {"nome": "unit_nome", "fantasia": "unit_fantasia"}, by=["conjunto"]
    )
    sets = sets.withColumn(
        "unidade", X.unit_display_name(F.col("unit_nome"), F.col("unit_fantasia"))
    )
    units = sets.select(BRAND, "unidade").distinct()
    rows = bridged_trailers(sets_with_coverages(sets, coverages(tables)), tables)
    rows = vehicle_or_trailer(rows, tables, fields=["board"], direct=False)
    # A null unit is a group of its own: counted under a flag, so the join can match it.
    key = [BRAND, "_unit", "_no_unit"]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("_no_unit", F.col("unidade").isNull()).withColumn(
            "_unit", F.coalesce("unidade", F.lit(""))
        )

    counts = distinct_count_by(keyed(rows), key, "placa", "quantidade_placas")
    result = zero_fill(keyed(units), counts, key).select("unidade", "quantidade_placas", BRAND)
    return order_rows(result, [("unidade", "asc"), (BRAND, "asc")]) if ordered else result


def _units_in_use(tables: Tables) -> DataFrame:
    """Units that occur on a set. Distinct unit ids come first: few rows reach the joins."""
    sets = tables["insurance_reg_set"]
    ids = sets.select(*scope_of(sets), "id_unity").distinct()
    named = lookup(ids, tables["representante"], {"id_unity": "codigo"}, {"cnpj_cpf": "doc"})
    return lookup(
        named,
        tables["catalogo"],
        {"doc": "cnpj_cpf"},
        {"nome": "nome", "fantasia": "fantasia", "cnpj_cpf": "cnpj_cpf"},
    )


def unit_search(tables: Tables, part: str = "DIGITAL") -> DataFrame:
    """Units whose registered name contains a text, ignoring case."""
    units = _units_in_use(tables).where(P.like_contains(F.upper("nome"), part))
    return units.select(
        F.upper("fantasia").alias("unidade"), "nome", "cnpj_cpf", F.lower(BRAND).alias(BRAND)
    ).distinct()


def unit_search_by_trade_name(tables: Tables, part: str = "TS") -> DataFrame:
    """Units whose trade name contains a text (case-sensitive)."""
    units = _units_in_use(tables).where(P.like_contains(F.col("fantasia"), part))
    return units.select(F.col("fantasia").alias("unidade"), F.lower(BRAND).alias(BRAND)).distinct()


def benefit_catalogue(
    tables: Tables, ids: Mapping[str, Iterable[int]] = C.BENEFIT_IDS
) -> DataFrame:
    """Benefits of interest, listed per brand. A catalogue without a brand column is
    shared by all brands."""
    prices = tables["price_list_benefits"]
    categories = prices.select(*scope_of(prices), "id_type_category").distinct()
    rows = lookup(
        categories,
        tables["type_category"],
        {"id_type_category": "id"},
        {"id_category": "id_category"},
    )
    rows = lookup(rows, tables["category"], {"id_category": "id"}, {"id_benefits": "id_benefits"})
    rows = lookup(
        rows,
        tables["benefits"],
        {"id_benefits": "id"},
        {"id": "id_beneficio", "description": "beneficio"},
    )
    schema = T.StructType(
        [T.StructField(BRAND, T.StringType()), T.StructField("id_beneficio", T.LongType())]
    )
    listed = [(brand, i) for brand, of_brand in ids.items() for i in of_brand]
    wanted = constant_rows(rows.sparkSession, schema, listed)
    rows = rows.join(wanted, ["id_beneficio", *[c for c in scope_of(rows) if c == BRAND]])
    return rows.select("id_beneficio", "beneficio", F.lower(BRAND).alias(BRAND)).distinct()
