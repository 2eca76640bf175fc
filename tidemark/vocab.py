"""Word lists and limits of the case-management domain.

Everything here is a default; each operator takes its own list or limit as an argument.
"""

from __future__ import annotations

# --- Fixed values: these must be exactly so for results to match -----------------------------

REQUIRED_COLUMNS = [
    "case_id",
    "client_name",
    "category",
    "priority",
    "intake_date",
    "closure_date",
    "status",
]

REFERENCE_DATE = "2026-08-22"

CANONICAL_CATEGORIES = [
    "Technical Support",
    "Billing",
    "Hardware",
    "General Inquiry",
    "Security Alert",
    "Account Access",
]

CATEGORY_ALIASES = {
    "technical support": "Technical Support",
    "tech support": "Technical Support",
    "tech": "Technical Support",
    "techsupport": "Technical Support",
    "it support": "Technical Support",
    "billing": "Billing",
    "billng": "Billing",
    "billing dept": "Billing",
    "invoicing": "Billing",
    "accounts receivable": "Billing",
    "hardware": "Hardware",
    "hardware maint": "Hardware",
    "hardware maintenance": "Hardware",
    "hardware repairs": "Hardware",
    "hw support": "Hardware",
    "general inquiry": "General Inquiry",
    "gen inquiry": "General Inquiry",
    "general inquiry query": "General Inquiry",
    "general info": "General Inquiry",
    "inquiry": "General Inquiry",
    "security alert": "Security Alert",
    "security": "Security Alert",
    "sec alert": "Security Alert",
    "cyber security": "Security Alert",
    "account access": "Account Access",
    "login access": "Account Access",
    "password reset": "Account Access",
    "user access": "Account Access",
}

PRIORITY_ALIASES = {
    "low": "Low",
    "p4": "Low",
    "medium": "Medium",
    "med": "Medium",
    "p3": "Medium",
    "high": "High",
    "p2": "High",
    "critical": "Critical",
    "urgent": "Critical",
    "p1": "Critical",
    "urgent override": "Critical",
}

STATUS_ALIASES = {
    "closed": "Closed",
    "resolved": "Closed",
    "open": "Open",
    "in progress": "In Progress",
    "inprogress": "In Progress",
    "pending": "Pending",
    "on hold": "Pending",
}

VALID_STATUSES = ["closed", "open", "pending", "in progress", "resolved"]
VALID_PRIORITIES = ["low", "medium", "high", "critical", "urgent"]

TRUE_TOKENS = ["yes", "y", "true", "1"]
FALSE_TOKENS = ["no", "n", "false", "0"]

MISSING_ID_TOKENS = ["", "nan", "none", "null"]
MISSING_DATE_TOKENS = ["", "nan", "none", "null", "nat"]
MISSING_TRIAGE_TOKENS = ["", "nan", "none", "nat"]

UNCATEGORIZED = "Uncategorized"
HIGH_URGENCY = ["High", "Critical"]

MAX_CONTACTS_CLEANING = 100
MAX_CONTACTS_ASSESSMENT = 1000
DEFAULT_CONTACTS = 3

CRITICAL_DATE_FLAGS = [
    "INVALID_INTAKE_FORMAT",
    "INVALID_CLOSURE_FORMAT",
    "FUTURE_INTAKE_DATE",
    "NEGATIVE_DURATION",
]

SEVERITY_WEIGHTS = {"CRITICAL": 3.0, "MAJOR": 1.5, "MINOR": 0.5}

DAYS_PER_MONTH = 30.4375
# --- end of fixed values ---------------------------------------------------------------------
