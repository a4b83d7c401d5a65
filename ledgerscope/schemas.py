"""The tables of the model: columns, keys and required columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {"text": T.StringType(), "int": T.LongType(), "real": T.DoubleType()}


@dataclass(frozen=True)
class Table:
    """columns: name and type; key: unique unless a part is null; required: never null."""

    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    required: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in self.columns])


def _table(columns: str, key: str, required: str) -> Table:
    parts = [c.split(":") for c in columns.split()]
    return Table(tuple((p[0], p[1] if len(p) > 1 else "text") for p in parts), tuple(key.split()), tuple(required.split()))


# Column names, types, keys and required columns of the public-records model.
TABLES = {
    "cities": _table("slug name uf ibge_code municipality_cnpj", "slug", "name uf ibge_code"),
    "sources": _table("city_slug id publisher scope authority url notes", "city_slug id", "city_slug id publisher scope authority url"),
    "officials": _table(
        "city_slug name office party legislature source_url observed_at", "city_slug name office observed_at",
        "city_slug name office source_url observed_at",
    ),
    "fiscal_observations": _table(
        "city_slug entity period metric value_brl:real reported_value_text precision budget_stage source_url source_location observed_at notes",
        "city_slug entity period metric source_url source_location", "city_slug entity period metric precision source_url observed_at",
    ),
    "legislative_observations": _table(
        "city_slug entity period metric value_numeric:real reported_value_text precision source_url source_location observed_at notes",
        "city_slug entity period metric source_url source_location", "city_slug entity period metric precision source_url observed_at",
    ),
    "procurements": _table(
        "city_slug source_system pncp_control_number process_number notice_number year:int modality_id:int modality_name object "
        "agency_cnpj agency_name sphere power unit_code unit_name municipality_ibge municipality_name uf published_at "
        "proposal_opening_at proposal_closing_at estimated_value:real homologated_value:real status_name source_url observed_at "
        "snapshot_sha256",
        "city_slug pncp_control_number", "city_slug source_system observed_at",
    ),
    "contracts": _table(
        "city_slug source_system pncp_control_number procurement_control_number contract_number year:int sequence:int "
        "contract_type_id:int contract_type_name process_number object agency_cnpj agency_name sphere power unit_code unit_name "
        "municipality_ibge municipality_name uf supplier_type supplier_document supplier_name initial_value:real global_value:real "
        "accumulated_value:real installments:int installment_value:real signed_at valid_from valid_to published_at updated_at "
        "source_url observed_at snapshot_sha256",
        "city_slug pncp_control_number", "city_slug source_system observed_at",
    ),
    "suppliers": _table(
        "city_slug document person_type name source_system first_observed_at", "city_slug document source_system",
        "city_slug document source_system first_observed_at",
    ),
    "expense_events": _table(
        "city_slug source_system event_key stage event_date agency_code agency_name supplier_document supplier_name process_number "
        "contract_number function_code function_name subfunction_code subfunction_name program_code program_name action_code "
        "action_name expense_nature_code expense_nature_name funding_source_code funding_source_name gross_value:real "
        "net_value:real source_url observed_at snapshot_sha256",
        "city_slug source_system event_key stage", "city_slug source_system event_key stage source_url observed_at",
    ),
    "revenue_events": _table(
        "city_slug source_system event_key event_date agency_code agency_name nature_code nature_name funding_source_code "
        "funding_source_name forecast_value:real updated_forecast_value:real collected_value:real source_url observed_at "
        "snapshot_sha256",
        "city_slug source_system event_key", "city_slug source_system event_key source_url observed_at",
    ),
}
