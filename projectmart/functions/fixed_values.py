"""The word lists, patterns, formats and weights that define the results.

Everything in this module is data that has to be exactly this for the tables to be right. The
functions that use it take it as a parameter, so a deployment can pass its own.
"""

# Date formats, tried in this order.
FIVE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd", "dd-MMM-yyyy", "MM-dd-yyyy")
THREE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd")

# Month formats, tried in this order ("yyyy-MM" means the first day of that month).
MONTH_FORMATS = ("yyyy-MM-dd", "yyyy-MM", "dd/MM/yyyy", "MMMM yyyy")
MONTH_FORMATS_SHORT = ("yyyy-MM-dd", "yyyy-MM", "dd/MM/yyyy")

# Key shapes. NARROW has the published widths; WIDE lets the same keys grow with the data.
NARROW_KEYS = {
    "employee_id": r"^EMP-\d{4}$",
    "project_id": r"^FRA-\d{4}-\d{4}$",
    "vendor_id": r"^VND-\d{4}$",
    "po_id": r"^PO-\d{5}$",
    "client_id": r"^CLI-\d{3}$",
}
WIDE_KEYS = {
    "employee_id": r"^EMP-\d{4,}$",
    "project_id": r"^FRA-\d{4,}-\d{4}$",
    "vendor_id": r"^VND-\d{4,}$",
    "po_id": r"^PO-\d{5,}$",
    "client_id": r"^CLI-\d{3,}$",
}
BUSINESS_ID = r"^\d{7}-\d$"

# Words read as a boolean (after folding case and spaces).
TRUE_WORDS = ("true", "yes", "y", "1")
FALSE_WORDS = ("false", "no", "n", "0")

# Enumerations: the valid values, and the known variants with the value each stands for.
ROLES = (
    "site_manager", "project_manager", "foreman", "safety_officer", "quantity_surveyor",
    "design_manager", "procurement_officer", "site_engineer", "planner", "bim_coordinator",
)
ROLE_VARIANTS = {
    "site  manager": "site_manager", "mgr": "site_manager", "project manager": "project_manager",
}
DEPARTMENTS = (
    "construction", "design", "procurement", "safety", "planning", "management", "finance",
)
UNASSIGNED = "unassigned"
DEPARTMENT_VARIANTS = {
    "sfaety": "safety", "unknown": UNASSIGNED, "n/a": UNASSIGNED, "": UNASSIGNED,
}
PROJECT_TYPES = (
    "residential", "commercial", "renovation", "pipe_renovation", "lifecycle", "data_center",
)
PROJECT_TYPE_VARIANTS = {
    "reno": "renovation", "pipe reno": "pipe_renovation", "datacenter": "data_center",
}
PROJECT_STATUSES = ("active", "completed", "tendering", "on_hold", "cancelled")
PROJECT_STATUS_VARIANTS = {
    "actve": "active", "complted": "completed", "on hold": "on_hold", "pending": "on_hold",
    "canceled": "cancelled",
}
MUNICIPALITY_VARIANTS = {
    "hki": "HKI", "helsinki": "HKI", "esp": "ESP", "espoo": "ESP",
    "van": "VAN", "vantaa": "VAN", "hyv": "HYV", "hyvinkää": "HYV",
}
VENDOR_TYPES = ("subcontractor", "material_supplier", "equipment_rental", "professional_services")
VENDOR_TYPE_VARIANTS = {
    "sub contractor": "subcontractor", "supplier": "material_supplier",
    "equip rental": "equipment_rental",
}
TRADES = (
    "concrete", "mep", "roofing", "finishing", "earthworks", "glazing", "steel", "electrical",
)
TRADE_VARIANTS = {"finising": "finishing", "earth works": "earthworks"}
RATINGS = ("low", "medium", "high")
APPROVALS = ("approved", "probation", "suspended", "blacklisted")
APPROVAL_VARIANTS = {
    "aproved": "approved", "on_probation": "probation", "blocked": "suspended",
}
MILESTONE_STATUSES = ("on_track", "at_risk", "delayed", "complete")
MILESTONE_STATUS_VARIANTS = {"on track": "on_track", "overdue": "delayed"}
COST_CATEGORIES = ("labour", "materials", "subcontract", "equipment", "overhead", "design")
COST_CATEGORY_VARIANTS = {"sub-contract": "subcontract", "equip": "equipment"}
PO_CATEGORIES = ("material", "subcontract", "equipment_rental", "professional_services")
PO_CATEGORY_VARIANTS = {
    "equipment rental": "equipment_rental", "equip": "equipment_rental",
    "prof_services": "professional_services",
}
PO_STATUSES = ("open", "partially_invoiced", "closed", "cancelled")
PO_STATUS_VARIANTS = {
    "partial_invoiced": "partially_invoiced", "canceled": "cancelled", "cancled": "cancelled",
}
PAYMENT_STATUSES = ("pending", "approved", "paid", "disputed", "overdue")
PAYMENT_STATUS_VARIANTS = {"aproved": "approved", "payed": "paid"}

# Evaluation scores: allowed range and weights (tenths).
SCORE_MIN, SCORE_MAX = 1, 10
SCORE_WEIGHTS = {
    "quality_score": "0.4", "schedule_score": "0.3", "safety_score": "0.2",
    "communication_score": "0.1",
}

# Invoice aging: upper bound in days of every closed bucket, then the open one.
AGING_BUCKETS = ((0, "current"), (30, "1-30 days"), (60, "31-60 days"), (90, "61-90 days"))
AGING_LAST = "90+ days"

# Project risk rule: points per percent over budget, late milestone, over-invoiced order and day.
RISK_POINTS = {"over_pct": "0.5", "delayed": 5, "over_invoiced": 3, "delay_day": "0.5"}
RISK_LEVELS = ((50, "high"), (20, "medium"))

# Model: label threshold, probability buckets, boosting parameters.
OVERRUN_RATIO = "1.10"
PROBABILITY_BUCKETS = ((0.3, "low"), (0.7, "medium"), (1.0, "high"))
BOOSTING = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "minInstancesPerNode": 20, "seed": 42}
TEST_FRACTION = 0.2

# Validation: largest tolerated share of orphans.
MAX_ORPHAN_PCT = 5.0

# Scorecard: lowest score of a band.
SCORECARD_BANDS = ((90.0, "green"), (70.0, "amber"))
