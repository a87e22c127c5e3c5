"""Which raw columns play which role."""

from __future__ import annotations

from dataclasses import dataclass


# Columns of the facts while they are built.
RESERVED = frozenset(
    {"date", "month", "year", "province_id", "district_id", "status", "total"}
    | {"_slot", "_part", "_before", "_position", "_n"}
    | {"_period", "_segment", "_rank", "_places", "_offset", "_first"}
)


@dataclass(frozen=True)
class StarSpec:
    """Roles of the columns of a wide raw table: one row per day and district,
    one integer column per case status."""

    date: str
    province_code: str
    province_name: str
    district_code: str
    district_name: str
    measures: tuple[str, ...]

    def __post_init__(self):
        if not self.measures:
            raise ValueError("a star needs at least one measure")
        lowered = [c.lower() for c in self.columns]
        repeated = sorted({c for c in lowered if lowered.count(c) > 1})
        if repeated:
            raise ValueError(f"column names repeat: {repeated}")
        taken = sorted(RESERVED.intersection(c.lower() for c in self.measures))
        if taken:
            raise ValueError(f"measures may not be named {taken}")

    @property
    def keys(self) -> tuple[str, ...]:
        return (
            self.date,
            self.province_code,
            self.province_name,
            self.district_code,
            self.district_name,
        )

    @property
    def columns(self) -> tuple[str, ...]:
        return self.keys + self.measures

    @property
    def statuses(self) -> tuple[str, ...]:
        """The measure names in the order in which Spark sorts strings."""
        return tuple(sorted(self.measures, key=lambda name: name.encode("utf-8")))

    def geo_code(self, geo: str) -> str:
        return {"province": self.province_code, "district": self.district_code}[geo]


# The column names of the source records.
CASE_SPEC = StarSpec(
    date="tanggal",
    province_code="kode_prov",
    province_name="nama_prov",
    district_code="kode_kab",
    district_name="nama_kab",
    measures=(
        "suspect_diisolasi",
        "suspect_discarded",
        "closecontact_dikarantina",
        "closecontact_discarded",
        "probable_diisolasi",
        "probable_discarded",
        "confirmation_sembuh",
        "confirmation_meninggal",
        "suspect_meninggal",
        "closecontact_meninggal",
        "probable_meninggal",
    ),
)
