"""The output tables of the workload, as named tables with declared columns."""

from __future__ import annotations

from vigie.functions.geo import RINGS_TYPE
from vigie.sources.named import NamedTables, Table

# The columns of the five output tables. Whole numbers are kept as such, geometries as rings.
OUTPUT_TABLES = {
    "stats_control_analysis": "id int not null, geozone_id int not null, year int not null, nb_controls int not null",
    "stats_detections_analysis": (
        f"id bigint not null, score double, object_type string, geometry {RINGS_TYPE}, geozone_id bigint, batch_year int, "
        "id_parcellaire string, first_detection boolean"
    ),
    "stats_parcels_analysis": "id int not null, geozone_id int not null, nb_parcels int not null, nb_parcels_in_ze int not null",
    "stats_pv_analysis": "id bigint not null, geozone_id bigint, year int, nb_pv bigint",
    "stats_status_analysis": "id int not null, geozone_id int not null, year int not null, nb_status_updates int not null",
}
#: Key of a table with a primary key.
UNIQUE = {"stats_parcels_analysis": ("id",)}
#: The zones imported by name, replaced name by name.
CUSTOM_ZONES = f"name string not null, geometry {RINGS_TYPE}, area double, perimeter double, n_rings int"


def create_output_tables(tables: NamedTables) -> list[Table]:
    """Declare the five tables; those that exist with the same declaration stay as they are."""
    return [
        tables.create(name, columns, key=UNIQUE.get(name, ()), unique=name in UNIQUE, if_not_exists=True) for name, columns in OUTPUT_TABLES.items()
    ]


def create_custom_zones(tables: NamedTables, buckets: int = 64) -> Table:
    return tables.create("custom_zones", CUSTOM_ZONES, key=("name",), unique=True, buckets=buckets, if_not_exists=True)
