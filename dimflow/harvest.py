"""The harvest-traceability warehouse: its source tables, its star and how its tables are used."""

from __future__ import annotations

from dimflow.operators.facts import CurrentRef, FactSpec, VersionedRef
from dimflow.plans.layout import Usage
from dimflow.plans.star import CurrentDim, Star, VersionedDim
from dimflow.registry import TableSpec

# The source tables with their types, and below their keys and load modes.
SCHEMAS = {
    "regions": "region_id int, region_name string, region_level string, parent_region_id int",
    "crop_types": "crop_type_id int, crop_name string, crop_category string, unit_of_measure string",
    "field_agents": "agent_id int, agent_code string, full_name string, region_id int, role string, "
    "hire_date date, is_active boolean",
    "supply_chain_nodes": "node_id int, node_type string, node_name string, region_id int, gps_lat double, "
    "gps_lon double",
    "farmers": "farmer_id int, farmer_code string, national_id string, full_name string, phone_number string, "
    "region_id int, registered_by_agent_id int, registered_at timestamp_ntz, updated_at timestamp_ntz, "
    "is_active boolean",
    "farm_plots": "plot_id int, plot_code string, farmer_id int, crop_type_id int, region_id int, "
    "latitude double, longitude double, area_hectares decimal(8,2), ownership_status string, "
    "polygon_source string, updated_at timestamp_ntz",
    "harvest_transactions": "transaction_id int, farmer_id int, plot_id int, crop_type_id int, node_id int, "
    "transaction_date timestamp_ntz, quantity_kg decimal(10,2), unit_price decimal(10,2), "
    "total_value decimal(12,2), moisture_content decimal(5,2), grade string, payment_status string, "
    "updated_at timestamp_ntz",
    "custody_events": "event_id int, batch_id string, from_node_id int, from_node_type string, "
    "to_node_id int, event_type string, event_timestamp timestamp_ntz, quantity_kg decimal(10,2), "
    "updated_at timestamp_ntz",
    "batch_transactions": "batch_id string, transaction_id int, quantity_allocated_kg decimal(10,2), "
    "updated_at timestamp_ntz",
    "certifications": "certification_id int, plot_id int, certification_body string, "
    "certification_type string, certificate_number string, issued_date date, expiry_date date, "
    "status string, updated_at timestamp_ntz",
}

# Ids of the growing tables per bucket: a load of recent activity rewrites the last buckets only.
ID_RANGE = 50_000_000

TABLES = [
    TableSpec("regions", ("region_id",)),
    TableSpec("crop_types", ("crop_type_id",)),
    TableSpec("field_agents", ("agent_id",)),
    TableSpec("supply_chain_nodes", ("node_id",)),
    TableSpec("farmers", ("farmer_id",), incremental=True, unique=True, natural_key="farmer_code"),
    TableSpec("farm_plots", ("plot_id",), incremental=True, unique=True, natural_key="plot_code"),
    TableSpec("harvest_transactions", ("transaction_id",), incremental=True, unique=True, id_range=ID_RANGE),
    TableSpec("custody_events", ("event_id",), incremental=True, unique=True, id_range=ID_RANGE),
    TableSpec(
        "batch_transactions",
        ("batch_id", "transaction_id"),
        incremental=True,
        unique=True,
        id_range=ID_RANGE,
        range_key="transaction_id",
    ),
    TableSpec("certifications", ("certification_id",), incremental=True, unique=True, natural_key="certificate_number"),
]

# Dimensions with their tracked columns, and the columns of the facts.
STAR = Star(
    versioned=(
        VersionedDim(
            "dim_farmer", "farmers", "farmer_key", "farmer_code", "farmer_id",
            ("region_id", "phone_number", "is_active"),
        ),
        VersionedDim(
            "dim_plot", "farm_plots", "plot_key", "plot_code", "plot_id",
            ("farmer_id", "ownership_status", "area_hectares", "latitude", "longitude", "polygon_source"),
        ),
    ),
    current=(
        CurrentDim("dim_crop_type", "crop_types", "crop_type_key", "crop_type_id"),
        CurrentDim("dim_supply_chain_node", "supply_chain_nodes", "node_key", "node_id"),
        CurrentDim("dim_location", "regions", "location_key", "region_id"),
        CurrentDim("dim_certification", "certifications", "certification_key", "certification_id", effective=True),
    ),
    facts=(
        FactSpec(
            name="fact_harvest_transactions",
            source="harvest_transactions",
            id_col="transaction_id",
            sk_col="transaction_sk",
            date_col="transaction_date",
            columns=(
                "transaction_sk", "farmer_key", "plot_key", "crop_type_key", "node_key", "date_key",
                "transaction_date", "quantity_kg", "unit_price", "total_value", "moisture_content", "grade",
                "payment_status",
            ),
            versioned=(
                VersionedRef("dim_farmer", "farmer_key", "farmer_id", "farmer_id"),
                VersionedRef("dim_plot", "plot_key", "plot_id", "plot_id"),
            ),
            current=(
                CurrentRef("dim_crop_type", "crop_type_key", "crop_type_id", "crop_type_id", "crop_type_key"),
                CurrentRef("dim_supply_chain_node", "node_key", "node_id", "node_id", "node_key"),
            ),
        ),
        FactSpec(
            name="fact_custody_events",
            source="custody_events",
            id_col="event_id",
            sk_col="event_sk",
            date_col="event_timestamp",
            columns=(
                "event_sk", "batch_id", "from_node_key", "to_node_key", "date_key", "event_type",
                "event_timestamp", "quantity_kg",
            ),
            current=(
                CurrentRef("dim_supply_chain_node", "node_key", "node_id", "from_node_id", "from_node_key"),
                CurrentRef("dim_supply_chain_node", "node_key", "node_id", "to_node_id", "to_node_key"),
            ),
        ),
    ),
)

# How queries use the star's tables.
USAGES = {
    "fact_harvest_transactions": Usage(
        ("farmer_key", "plot_key", "crop_type_key", "node_key", "date_key"), "date_key", ("node_key", "crop_type_key")
    ),
    "fact_custody_events": Usage(("from_node_key", "to_node_key", "date_key"), "date_key", ("event_type",)),
    "dim_farmer": Usage(("farmer_key",), None, ("region_id", "is_current")),
    "dim_plot": Usage(("plot_key",), None, ("farmer_id", "is_current")),
    "dim_crop_type": Usage(("crop_type_key",)),
    "dim_supply_chain_node": Usage(("node_key",), None, ("node_type",)),
    "dim_location": Usage(("location_key",)),
    "dim_date": Usage(("date_key",)),
}
