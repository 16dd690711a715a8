"""Declared schemas of the source tables (the sources themselves are untyped files)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "ts": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "insurance_registration": _schema(id="long", customer_id="long"),
    "insurance_reg_set": _schema(
        id="long",
        parent="long",
        id_status="long",
        id_unity="long",
        id_consultant="long",
        id_user_support="long",
        id_renovated_set="long",
        data_registration="ts",
        date_inital_effect="ts",
        date_final_effect="ts",
        date_activation="ts",
        date_cancellation="ts",
        user_name_cancellation="string",
    ),
    "insurance_reg_set_coverage": _schema(
        id="long",
        parent="long",
        id_vehicle="long",
        id_trailer="long",
        id_status="long",
        id_price_list="long",
        updated_at="long",
        date_initial_effect="ts",
        date_final_effect="ts",
    ),
    "insurance_vehicle": _schema(
        id="long",
        board="string",
        chassi="string",
        code_type_vehicle="long",
        code_brand_vehicle="long",
    ),
    "insurance_reg_set_cov_trailer": _schema(parent="long", id_trailer="long"),
    "insurance_trailer": _schema(id="long", board="string", chassi="string"),
    "insurance_status": _schema(id="long", description="string"),
    "cliente": _schema(codigo="long", cnpj_cpf="string"),
    "catalogo": _schema(cnpj_cpf="string", nome="string", fantasia="string"),
    "representante": _schema(codigo="long", cnpj_cpf="string"),
    "vendedor": _schema(codigo="long", descricao="string"),
    "price_list_benefits": _schema(id="long", id_type_category="long"),
    "type_category": _schema(id="long", id_category="long"),
    "category": _schema(id="long", id_benefits="long"),
    "benefits": _schema(id="long", description="string"),
    "web_user": _schema(id="long", user_name="string"),
    # Joined by the original reports without using a column; kept for SQL users only.
    "insurance_reg_historic": _schema(id_set="long"),
    "tipo_veiculo": _schema(codigo="long"),
}

# The overdue-invoice list is the result of a query that is not ours: an input table.
#: Columns that no report reads; files may lack them.
OPTIONAL_COLUMNS = ("code_type_vehicle", "code_brand_vehicle")

INVOICES_SCHEMA = _schema(
    ponteiro="long",
    historico="int",
    conjunto="long",
    matricula="long",
    empresa="string",
    associado="string",
)
