"""The contract chain: registration, set, coverage, plate, and its lookups.

Shape of every plan built here, and why it holds at scale:

1. Sets are filtered by status and joined to their registration first, coverages are
   filtered by benefit status and joined to their bridged trailers; only then do the two
   large tables meet on the set id.
2. `reduce_plates` keeps one candidate per plate *reference* (vehicle id, bridged
   trailer id, direct trailer id) before any plate table is read. Rows with equal
   references have equal plate and chassis, so the later choice per chassis can only
   fall on that candidate. A plate that holds a third of all coverages is cut to one
   row per map task, and the plate joins run on plates, not on coverages.
3. Names (customer, unit, consultant, user, benefit) are looked up on what is left,
   before the last choice per chassis, so a lookup table with repeated keys cannot
   multiply results.

Lookups that no report reads (vehicle type, set history, invoices, addresses, vehicle
makes) are left out: a left join without a used column only repeats rows, which the
choice per chassis, DISTINCT or COUNT(DISTINCT) absorbs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators.dedupe import keep_first
from placaflow.operators.joins import SPAN, exclude_keys, has_span, lookup, scope_of, shared_scope
from placaflow.operators.ordering import OrderSpec
from placaflow.operators.sets import union_by_name
from placaflow.session import Steps

Tables = Mapping[str, DataFrame]

PLATE_REFERENCE = ("id_veiculo", "id_carroceria", "id_reboque")
ROW_ID = ("conjunto", "coverage_id")


def contract_sets(
    tables: Tables, where: Column | None = None, flags: Mapping[str, Column] | None = None
) -> DataFrame:
    """Sets with their status and registration, and conditions on them as flag columns.

    Every report filters on a set column, so the registration join is an inner one.
    """
    source = tables["insurance_reg_set"]
    sets = source.select(
        *scope_of(source),
        F.col("id").alias("conjunto"),
        F.col("parent").alias("matricula"),
        F.col("id_renovated_set").alias("conjunto_renovado"),
        "id_status",
        "id_unity",
        "id_consultant",
        "id_user_support",
        F.col("data_registration").alias("data_registro"),
        X.effective_start(F.col("date_inital_effect"), F.col("date_final_effect")).alias(
            "inicio_vig"
        ),
        F.col("date_final_effect").cast("date").alias("fim_vig"),
        F.col("date_activation").cast("date").alias("ativado_em"),
        "date_cancellation",
        F.col("date_cancellation").cast("date").alias("data_cancelamento"),
        F.col("user_name_cancellation").alias("usuario_cancelamento"),
    )
    sets = status_lookup(sets, tables, "id_status", {"id": "status_id", "description": "status"})
    if where is not None:
        sets = sets.where(where)
    if flags:
        sets = sets.withColumns(dict(flags))
    sets = sets.drop("id_status", "status_id", "date_cancellation")
    return lookup(
        sets,
        tables["insurance_registration"],
        on={"matricula": "id"},
        take={"customer_id": "customer_id"},
        how="inner",
    )


def coverages(tables: Tables, where: Column | None = None) -> DataFrame:
    """Coverages with their benefit status. One without an id counts like any other; it
    only has no bridged trailers."""
    source = tables["insurance_reg_set_coverage"]
    rows = source.select(
        *scope_of(source),
        F.col("id").alias("coverage_id"),
        F.col("parent").alias("set_id"),
        F.col("id_vehicle").alias("id_veiculo"),
        F.col("id_trailer").alias("id_reboque"),
        "id_status",
        "id_price_list",
        "updated_at",
        X.effective_start(F.col("date_initial_effect"), F.col("date_final_effect")).alias(
            "data_ativacao_beneficio"
        ),
    )
    rows = status_lookup(rows, tables, "id_status", {"description": "status_beneficio"})
    if where is not None:
        rows = rows.where(where)
    return rows.drop("id_status")


def sets_with_coverages(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per coverage of a set (a set that holds most coverages is split)."""
    take = {c: c for c in rows.columns if c not in (*scope_of(rows), "set_id")}
    return lookup(sets, rows, {"conjunto": "set_id"}, take, how="inner")


def uncovered_sets(sets: DataFrame, tables: Tables) -> DataFrame:
    """Sets without any coverage.

    Found apart from the covered ones: Spark cannot split a set with most coverages on
    the right side of a left join, but it can in an inner join.
    """
    source = tables["insurance_reg_set_coverage"]
    known = source.select(F.col("parent").alias("conjunto"), *scope_of(source)).distinct()
    return exclude_keys(sets, known, known.columns)


def contract_chain(tables: Tables) -> DataFrame:
    """Every registration with its sets and their coverages; a registration may have no set
    and a set no coverage. What is missing is null."""
    sets = contract_sets(tables)
    covered = sets_with_coverages(sets, coverages(tables))
    source, registered = tables["insurance_reg_set"], tables["insurance_registration"]
    registered = registered.select(*scope_of(registered), F.col("id").alias("matricula"))
    known = source.select(*shared_scope(registered, source), F.col("parent").alias("matricula"))
    return union_by_name(
        [covered, uncovered_sets(sets, tables), exclude_keys(registered, known, known.columns)],
        allow_missing=True,
    )


def bridged_trailers(rows: DataFrame, tables: Tables) -> DataFrame:
    """Rows of coverages with the trailers attached through the bridge table.

    Called after the sets are joined, so that only coverages of wanted sets are shuffled.
    Coverages with bridge entries and those without are found apart: in an inner join Spark
    can split a coverage that bridges most trailers, on either side, and in an anti-join a
    coverage that fills most rows. Repeated entries of a trailer count once.
    """
    bridge = tables["insurance_reg_set_cov_trailer"]
    entries = bridge.select("parent", "id_trailer", *scope_of(bridge)).distinct()
    # Said of both joins, so that they ask for one and the same shuffle of the rows. The test that
    # is always true keeps Spark from moving the anti-join below other joins and projections.
    keys = ["coverage_id", *shared_scope(rows, entries), *(SPAN if has_span(rows, entries) else ())]
    present = " AND ".join(f"`{c}` IS NOT NULL" for c in keys)
    named = rows.where(present).where(F.spark_partition_id() >= 0)
    with_entry = lookup(
        named, entries, {"coverage_id": "parent"}, {"id_trailer": "id_carroceria"}, how="inner"
    )
    known = bridge.select(F.col("parent").alias("coverage_id"), *scope_of(bridge)).where(
        "coverage_id IS NOT NULL"
    )
    without = exclude_keys(named, known, ["coverage_id", *scope_of(known)])
    without = without.unionByName(rows.where(f"NOT ({present})"))
    kind = entries.schema["id_trailer"].dataType
    return with_entry.unionByName(without.withColumn("id_carroceria", F.lit(None).cast(kind)))


def steps_over(tables: Tables, reads: Iterable[str] | None = None) -> Steps:
    """Steps for plans over the coverages, the largest table."""
    return Steps(tables["insurance_reg_set_coverage"], reads)


def contract_rows(
    sets: DataFrame, tables: Tables, where: Column | None, steps: Steps
) -> DataFrame:
    """Coverages of the sets with their bridged trailers.

    In steps the trailers come first, onto the narrow rows of the coverages: what the sets add to
    a row then passes one shuffle less.
    """
    if not steps.on:
        return bridged_trailers(sets_with_coverages(sets, coverages(tables, where)), tables)
    return steps.cut(sets_with_coverages(sets, bridged_coverages(tables, where, steps)), "contracts")


def bridged_coverages(tables: Tables, where: Column | None, steps: Steps) -> DataFrame:
    """Coverages with their bridged trailers, one step."""
    return steps.cut(bridged_trailers(coverages(tables, where), tables), "bridged")


def reduce_plates(df: DataFrame, order: OrderSpec, also: Iterable[str] = ()) -> DataFrame:
    """First row per plate reference (see the module text).

    The first id that is present leads the key: it follows from the others, and sorting
    by a column that tells most rows apart is cheapest.
    """
    first_id = f"coalesce({', '.join(PLATE_REFERENCE)})"
    return keep_first(df, [first_id, *PLATE_REFERENCE, *also, *scope_of(df)], order)


def vehicle_or_trailer(
    df: DataFrame,
    tables: Tables,
    fields: Iterable[str] = ("board", "chassi", "id"),
    direct: bool = True,
    by: Iterable[str] = ROW_ID,
    steps: Steps | None = None,
) -> DataFrame:
    """Plate, chassis and id: of the vehicle, else the bridged, else the direct trailer.

    `by` names columns that tell the rows apart (missing ids are spread by them). `steps` cuts
    between the joins, where the rows are not reduced to one a plate.
    """
    fields = list(fields)
    joined = lookup(
        df,
        tables["insurance_vehicle"],
        on={"id_veiculo": "id"},
        take={f: f"veh_{f}" for f in fields},
        spread_nulls_by=by,
    )
    joined = steps.cut(joined, "vehicles") if steps else joined
    joined = lookup(
        joined,
        tables["insurance_trailer"],
        on={"id_carroceria": "id"},
        take={f: f"bri_{f}" for f in fields},
        spread_nulls_by=by,
    )
    origins = ["veh", "bri"]
    if direct:
        joined = steps.cut(joined, "trailers") if steps else joined
        joined = lookup(
            joined,
            tables["insurance_trailer"],
            on={"id_reboque": "id"},
            take={f: f"dir_{f}" for f in fields},
            spread_nulls_by=by,
        )
        origins.append("dir")
    names = {"board": "placa", "chassi": "chassi", "id": "id_placa"}
    joined = joined.withColumns({names[f]: X.plate_identity(f, origins) for f in fields})
    return joined.drop(*[f"{origin}_{f}" for origin in origins for f in fields])


def contract_base(
    tables: Tables, set_where: Column | None = None, coverage_where: Column | None = None
) -> DataFrame:
    """Every coverage row of the contract chain that has a plate and a chassis."""
    sets = contract_sets(tables, set_where)
    rows = sets_with_coverages(sets, coverages(tables, coverage_where))
    df = vehicle_or_trailer(bridged_trailers(rows, tables), tables)
    return df.where(P.identity_not_null(F.col("placa"), F.col("chassi")))


# Lookups -----------------------------------------------------------------------


def status_lookup(
    df: DataFrame, tables: Tables, key: str, take: Mapping[str, str]
) -> DataFrame:
    return lookup(df, tables["insurance_status"], {key: "id"}, take)


def customer_lookup(df: DataFrame, tables: Tables, by: Iterable[str] = ROW_ID) -> DataFrame:
    df = lookup(
        df,
        tables["cliente"],
        {"customer_id": "codigo"},
        {"cnpj_cpf": "customer_doc"},
        spread_nulls_by=by,
    )
    df = lookup(
        df,
        tables["catalogo"],
        {"customer_doc": "cnpj_cpf"},
        {"nome": "cliente"},
        spread_nulls_by=by,
    )
    return df.drop("customer_doc")


def unit_lookup(
    df: DataFrame,
    tables: Tables,
    take: Mapping[str, str] = {"fantasia": "unidade"},
    by: Iterable[str] = ROW_ID,
) -> DataFrame:
    df = lookup(
        df,
        tables["representante"],
        {"id_unity": "codigo"},
        {"cnpj_cpf": "unit_doc"},
        spread_nulls_by=by,
    )
    df = lookup(
        df, tables["catalogo"], {"unit_doc": "cnpj_cpf"}, dict(take), spread_nulls_by=by
    )
    return df.drop("unit_doc")


def consultant_lookup(df: DataFrame, tables: Tables) -> DataFrame:
    return lookup(
        df,
        tables["vendedor"],
        {"id_consultant": "codigo"},
        {"descricao": "consultor"},
        spread_nulls_by=ROW_ID,
    )


def support_user_lookup(df: DataFrame, tables: Tables) -> DataFrame:
    """Support user of the set.

    The id is a column of the set itself, so this equals a join to the distinct
    (set, user) pairs of `support_users` without scanning the sets a second time.
    """
    return lookup(
        df,
        tables["web_user"],
        {"id_user_support": "id"},
        {"user_name": "usuario_suporte"},
        spread_nulls_by=ROW_ID,
    )


def support_users(tables: Tables) -> DataFrame:
    """Distinct (set, support user) pairs; sets without a user do not appear."""
    sets = tables["insurance_reg_set"]
    pairs = lookup(
        sets.select(*scope_of(sets), F.col("id").alias("conjunto"), "id_user_support"),
        tables["web_user"],
        {"id_user_support": "id"},
        {"user_name": "suporte"},
        how="inner",
    )
    return pairs.drop("id_user_support").distinct()


def benefit_lookup(df: DataFrame, tables: Tables, by: Iterable[str] = ROW_ID) -> DataFrame:
    """Price list, type category, category, benefit."""
    df = lookup(
        df,
        tables["price_list_benefits"],
        {"id_price_list": "id"},
        {"id_type_category": "id_type_category"},
        spread_nulls_by=by,
    )
    df = lookup(
        df,
        tables["type_category"],
        {"id_type_category": "id"},
        {"id_category": "id_category"},
        spread_nulls_by=by,
    )
    df = lookup(
        df,
        tables["category"],
        {"id_category": "id"},
        {"id_benefits": "id_benefits"},
        spread_nulls_by=by,
    )
    df = lookup(
        df,
        tables["benefits"],
        {"id_benefits": "id"},
        {"description": "beneficio"},
        spread_nulls_by=by,
    )
    return df.drop("id_type_category", "id_category", "id_benefits")


def names(
    df: DataFrame, tables: Tables, benefit: bool = False, steps: Steps | None = None
) -> DataFrame:
    """Customer, unit, consultant and support user; optionally the benefit."""
    df = customer_lookup(df, tables)
    df = unit_lookup(steps.cut(df, "customers") if steps else df, tables)
    df = consultant_lookup(steps.cut(df, "units") if steps else df, tables)
    df = support_user_lookup(df, tables)
    return benefit_lookup(df, tables) if benefit else df


NAME_COLUMNS = ("cliente", "unidade", "consultor", "usuario_suporte")
