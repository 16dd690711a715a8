"""Brands, business constants and report parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class BrandSpec:
    """One brand: its label in results, its SQL namespace, its landing folder."""

    label: str
    namespace: str
    folder: str
    rank: int


# Brand labels, namespaces and folders, in report order.
BRANDS = (
    BrandSpec("Segtruck", "silver", "vilesoft", 1),
    BrandSpec("Stcoop", "stcoop", "stcoop", 2),
    BrandSpec("Viavante", "viavante", "viavante", 3),
    BrandSpec("Tag", "tag", "tag", 4),
)

# Status ids and descriptions.
ACTIVE_SET_STATUS_ID = 7
ACTIVE = "ATIVO"
CANCELLED = "CANCELADO"
FINALISED = "FINALIZADO"
PARTIAL_BENEFIT_STATUSES = ("CANCELADO", "FINALIZADO", "NAO RENOVADO")
OPEN_SET_STATUSES = ("ATIVO", "RENOVACAO")
CANCELLED_SET_STATUSES = ("CANCELADO", "CANCELADO_PARCIAL")

# Tick encoding of coverage updates (100 ns ticks since year 1).
TICKS_AT_1900 = 599266080000000000
TICKS_PER_DAY = 864000000000

# Labels and patterns of the report.
FULL = "INTEGRAL"
PARTIAL = "PARCIAL"
KINDS = (ACTIVE, FULL, PARTIAL)
YES = "SIM"
NO = "NÃO"
MISSING_TEXT = "N/A"
TOTAL_LABEL = "Total"
FRANCHISE_PATTERN = "UNIDADE|MF|FRANQUEADO|MICRO|TS CONSULTORIA|TRANSDESK DIGITAL"
FRANCHISE_CATEGORY = "UNIDADES/FRANQUIAS"
PARTNER_CATEGORY = "PARCEIROS/CORRETORES/FTR"
FRANCHISE_NAME_MARK = "FTR"
SATURDAY_MARK = "SÁBADO"
SUNDAY_MARK = "DOMINGO"

# Members left out of the overdue list.
TEST_MEMBER_MARK = "TESTE"
EXCLUDED_ASSOCIATION = "APROSSIL - ASSOCIACAO DE PROPRIETARIOS DE CAMINHOES DO SUL D"
EXCLUDED_ASSOCIATION_BRANDS = ("Viavante", "Stcoop", "Segtruck")

# Benefit ids of interest per brand, units of the filtered backfills.
BENEFIT_IDS = {
    "Segtruck": (2, 3, 4, 7, 24, 25, 26, 29),
    "Stcoop": (24, 25, 26, 29),
    "Viavante": (40, 41, 42, 45),
    "Tag": (2, 3, 4, 7, 24, 25, 26, 29, 34, 35, 36, 37, 38, 39),
}
ALLOWED_UNITS = ("TRANSDESK DIGITAL LTDA",)

CONTRACT_DAYS_BACK = 364
DATE_FLOOR = dt.date(2025, 1, 1)
OPEN_INVOICE = 1
