"""Parameters of the pension-flow build: files, codes, thresholds and dates."""

from __future__ import annotations

from dataclasses import dataclass, field

# Columns of each raw file, in the spelling of the source.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "contributions": ("coenti", "damesano", "tipoProd", "contrib", "benef"),
    "redemptions_vgbl": ("damesano", "coenti", "resg_total", "resg_parcial", "Resg_Pag_programado"),
    "redemptions_pgbl": ("damesano", "coenti", "resg_total", "resg_parcial", "Resg_Pag_programado"),
    "transfers": ("COENTI", "DAMESANO", "TIPOTRANSF", "TIPOPLANO", "VALOR", "QUANTIDADE"),
    "stock_vgbl": ("coenti", "damesano", "fundos"),
    "stock_pgbl": ("coenti", "damesano", "fundos"),
    "pgbl_by_state": ("COENTI", "DAMESANO", "UF", "CONTRIB", "BENEFPAGO", "RESGPAGO", "NUMPARTIC", "NUMBENEF", "NUMRESG"),
    "companies": ("Coenti", "Noenti", "Cogrupo", "Nogrupo"),
    "group_history": ("damesano", "coenti", "noenti", "cogrupo", "nogrupo"),
}

# Standard names of the two columns whose spelling varies, in lower case.
STANDARD_NAMES = {"coenti": "cod_empresa", "damesano": "ano_mes"}

# Columns the source documents for redemptions.
DOCUMENTED_REDEMPTIONS = ("damesano", "coenti", "resg_total", "resg_parcial")

COMPANY_PATTERN = r"^\d{5}$"
UNKNOWN_GROUP = {"cod_grupo": "NAO_INFORMADO", "nome_grupo": "GRUPO NÃO INFORMADO", "fl_grupo_generico": True}
GENERIC_GROUP = "99999"


@dataclass(frozen=True)
class Settings:
    """Everything a build depends on besides the data."""

    folder: str
    snapshot_date: str
    max_month: str
    files: dict[str, str] = field(default_factory=lambda: {name: f"{name}.csv" for name in RAW_COLUMNS})
    encoding: str = "windows-1252"
    products: tuple[str, ...] = ("VGBL", "PGBL")
    known_products: tuple[str, ...] = ("PGBL", "VGBL", "PrevTrad")
    directions: dict[str, str] = field(default_factory=lambda: {"R": "ACEITA", "D": "CEDIDA"})
    start: str = "2014-01-01"
    end: str = "2026-07-01"
    last_full_year: int = 2025
    ytd_month: int = 7
    first_ytd_year: int = 2021
    monthly_from: str = "2022-01-01"
    grain_break: str = "2013-12-01"
    grain_history: tuple[str, str] = ("2010-01-01", "2016-12-01")
    min_average_transfer: float = 100
    max_asymmetry_pct: float = 15
    max_uncovered_value: float = 1e6
    min_reconciled_pct: float = 90
    outlier_rows: int = 12
    outlier_times: float = 5
    outlier_floor: float = 50_000_000
    max_unknown_share_pct: float = 5
    buckets: int = 0  # above 0, silver flows and the bridge are bucketed by company into this many files
