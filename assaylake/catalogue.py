"""The two tabular datasets and the map layer the engine ships with.

Names, permitted values and column mappings are fixed values that stored data already uses.
"""

from __future__ import annotations

from assaylake.contract import Alias, Contract, Field, RuleSpec, Source
from assaylake.functions.transforms import CURRENCY_TO_FLOAT, DATE_US_TO_ISO

# Region codes and names.
REGIONS = (
    ("NCR", "National Capital Region"), ("CAR", "Cordillera Administrative Region"), ("R1", "Ilocos Region"),
    ("R2", "Cagayan Valley"), ("R3", "Central Luzon"), ("R4A", "CALABARZON"), ("R4B", "MIMAROPA"),
    ("R5", "Bicol Region"), ("R6", "Western Visayas"), ("R7", "Central Visayas"), ("R8", "Eastern Visayas"),
    ("R9", "Zamboanga Peninsula"), ("R10", "Northern Mindanao"), ("R11", "Davao Region"),
    ("R12", "SOCCSKSARGEN"), ("R13", "Caraga"), ("NIR", "Negros Island Region"),
)

# Permitted values.
AGENCIES = ("PCHRD", "PCAARRD", "PCIEERD", "ASTI", "FNRI", "ITDI", "MIRDC", "TAPI")
PROGRAM_AREAS = ("Health", "Agriculture", "Industry", "Basic Research", "ICT", "Disaster Resilience")
PROJECT_STATUS = ("Proposed", "Ongoing", "Completed", "Terminated", "On-Hold")
FUNDING = ("GAA", "Special Trust Fund", "Foreign-Assisted", "Counterpart")
EQUIPMENT_CATEGORIES = ("Laboratory", "ICT", "Field Survey", "Processing")
CONDITIONS = ("Serviceable", "Needs Repair", "Condemned", "Under Repair")
FACILITY_TYPES = ("government", "hospital", "school")
COUNTRY_BOX = (116.9, 4.5, 126.7, 21.2)
PROGRAM_START, PROGRAM_END = "2017-01-01", "2026-12-31"

PROJECT_RULES = (
    RuleSpec("budget_within_allocation", "pair_at_least", "budget_allocated_php", "hard",
             {"other": "budget_utilized_php"}),
    RuleSpec("dates_are_ordered", "pair_above", "end_date", "soft", {"other": "start_date"}),
    RuleSpec("start_in_program_window", "between", "start_date", "hard",
             {"low": PROGRAM_START, "high": PROGRAM_END}),
)

PROJECT_MONITORING = Contract(
    dataset="project_monitoring",
    description="Research project monitoring",
    unique_fields=("project_id",),
    fields=(
        Field("project_id", required=True),
        Field("agency", required=True, allowed=AGENCIES),
        Field("region", required=True, allowed=tuple(code for code, _ in REGIONS)),
        Field("program_area", required=True, allowed=PROGRAM_AREAS),
        Field("project_title", required=True),
        Field("principal_investigator", required=True),
        Field("start_date", "date", required=True),
        Field("end_date", "date"),
        Field("budget_allocated_php", "float", required=True, minimum=0),
        Field("budget_utilized_php", "float", required=True, minimum=0),
        Field("status", required=True, allowed=PROJECT_STATUS),
        Field("funding_source", required=True, allowed=FUNDING),
    ),
    sources=(
        Source("regional_files", "file", {"agency": "PCHRD", "region": "R4A"}, {"pattern": "*.csv"}, (
            Alias("Proj_ID", "project_id"), Alias("Program", "program_area"),
            Alias("Project Title", "project_title"), Alias("PI Name", "principal_investigator"),
            Alias("Start_Date (mm/dd/yyyy)", "start_date", DATE_US_TO_ISO),
            Alias("End_Date (mm/dd/yyyy)", "end_date", DATE_US_TO_ISO),
            Alias("Budget Allocated (Php)", "budget_allocated_php", CURRENCY_TO_FLOAT),
            Alias("Budget Utilized (Php)", "budget_utilized_php", CURRENCY_TO_FLOAT),
            Alias("Status", "status"), Alias("Fund Source", "funding_source"),
        ), 20),
        Source("monitoring_api", "api", options={"field_path": ["data", "records"]}, priority=10),
        Source("project_changes", "kafka_cdc", {"agency": "PCHRD", "region": "R4A"},
               {"topic_pattern": "cdc.project_schema.*"}, priority=30),
    ),
    rules=PROJECT_RULES,
)

RD_EQUIPMENT_INVENTORY = Contract(
    dataset="rd_equipment_inventory",
    description="Research equipment inventory",
    unique_fields=("equipment_id",),
    fields=(
        Field("equipment_id", required=True),
        Field("agency", required=True, allowed=("PCAARRD",)),
        Field("equipment_name", required=True),
        Field("equipment_category", required=True, allowed=EQUIPMENT_CATEGORIES),
        Field("acquisition_date", "date", required=True),
        Field("acquisition_cost_php", "float", required=True),
        Field("condition_status", required=True, allowed=CONDITIONS),
        Field("custodian_name"),
        Field("assigned_office"),
        Field("last_assignment_date", "date"),
    ),
    sources=(
        Source("equipment_registry", "db_multitable", {"agency": "PCAARRD"},
               {"tables": ["equipment", "equipment_assignment"], "join_key": "equip_id"}, (
                   Alias("equip_id", "equipment_id"), Alias("equip_name", "equipment_name"),
                   Alias("category", "equipment_category"), Alias("acq_date", "acquisition_date"),
                   Alias("acq_cost_php", "acquisition_cost_php", CURRENCY_TO_FLOAT),
                   Alias("status", "condition_status"), Alias("custodian", "custodian_name"),
                   Alias("office", "assigned_office"), Alias("assign_date", "last_assignment_date"),
               ), 10),
    ),
)

CRITICAL_FACILITIES = {
    "layer": "critical_facilities",
    "version": "1.0",
    "description": "Hospitals, schools and government sites with a contact person per site",
    "geometry_type": "Point",
    "allow_multi": False,
    "source_crs": "EPSG:4326",
    "target_crs": "EPSG:4326",
    "bbox": list(COUNTRY_BOX),
    "unique_key": "facility_id",
    "field_aliases": {
        "facity_Id": "facility_id", "facility_t": "facility_type", "contact_pe": "contact_person",
        "contact_ph": "contact_phone", "contact_em": "contact_email",
    },
    "attributes": [
        {"name": "facility_id", "required": True},
        {"name": "name", "required": True},
        {"name": "facility_type", "required": True, "permissible_values": list(FACILITY_TYPES)},
        {"name": "address"}, {"name": "contact_person"}, {"name": "contact_phone"},
        {"name": "contact_email"}, {"name": "remarks"},
    ],
    "thresholds": {"max_null_geom_pct": 0, "max_repaired_pct": 2},
    "pii": {
        "scan": "all_text",
        "score_threshold": 0.4,
        "skip_columns": ["name", "address"],
        "columns": {
            "contact_person": {"serving": "pseudonymize"},
            "contact_email": {"serving": "mask"},
            "contact_phone": {"serving": "mask_last3"},
            "remarks": {"serving": "replace_in_text"},
        },
    },
    "serving": {"expose_columns": ["facility_id", "name", "facility_type", "address"]},
}

CONTRACTS = {c.dataset: c for c in (PROJECT_MONITORING, RD_EQUIPMENT_INVENTORY)}
