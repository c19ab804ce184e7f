"""Values the jobs are parameterised with.

Deployment settings (templates, addresses, caps) have neutral defaults and are
meant to be replaced by the caller.
"""

from __future__ import annotations

# --- Fixed values: identifiers, word lists and windows the rules depend on -----
ONLINE_SERVICES = (990054338, 990054339, 990054340)
WORKLOAD_SERVICES = (990054338, 990054339, 990054340, 990054352)
STRICT_DEPARTMENTS = (992092102, 992092953, 992092954, 992092955, 992092956, 764)
PREINVOICE_PLAN_TYPE = 204
SURVEY_BRANCHES = (1, 5, 12, 3, 8, 10, 17)
SURVEY_AGE = (18, 50)
SURVEY_PAYER = "Наличная категория приема"
SURVEY_DEPARTMENTS_EXCLUDED = ("ПРОЦЕДУРНЫЙ КАБИНЕТ", "Взятие мазков (Заборники)")
SURVEY_SERVICE_WORDS_EXCLUDED = (
    "анестез",
    "взятие",
    "онлайн",
    "диспансерный",
    "заключение",
    "звонок",
    "соскоб",
    "освидетельствование",
    "описание снимков",
    "педиатр",
    "детск",
    "псих",
    "ревматолог",
    "терапевт",
    "физиотерапевт",
    "программа",
)
SURVEY_STAFF_WORDS_EXCLUDED = ("сестра", "лаборант")
OFFSET_BRANCHES = {9: 120, 15: 120}  # branch id -> minutes ahead of the server clock
OUTGOING_MOVEMENT_TYPES = (2, 5, 102)
EXCLUDED_INCOME_REFS = (10, 11)
ONLINE_STATUSES = (1, 2, 5)
NEW_LOOKBACK_S = 600
NEW_LOOKBACK_STRICT_S = 345.6  # 0.004 day
REMINDER_LEAD_S = 360
PAYMENT_CREATED_MIN = 30
PAYMENT_START_MIN = 30
SURVEY_HOURS = (11, 21)
SURVEY_DELAY_H = 3
SURVEY_EVENING_HOUR = 18
FILE_AGE_MIN = 120
LEDGER_DAYS = 2  # marks older than this concern nothing that a poll picks
LEDGER_KEEP = 10
ALERT_ORDINALS = {
    "conference": 1001,
    "operational": 1001,
    "warehouse": 11,
    "folder": 12,
    "server": 3,
}
DELIVERY_STATES = {
    "-1": "queued",
    "0": "rejected",
    "1": "undelivered",
    "2": "sent, state unknown",
    "3": "delivered",
}
USER_STATUSES = {
    -2: "inactive",
    -1: "invalid",
    0: "offline",
    1: "online",
    2: "busy",
    5: "host",
}
CONFERENCE_TYPES = {0: "symmetric", 1: "asymmetric", 3: "role-based"}
PHONE_COLUMNS = ("phone3", "phone2", "phone1", "phoneint")
MOBILE_PREFIX = "9"
COUNTRY_PREFIX = "7"

# --- Deployment settings: neutral defaults -------------------------------------
TEMPLATES = {
    "new": "Your online visit is booked for @dateTime",
    "reminder_patient": "Your online visit starts in a few minutes",
    "reminder_doctor": "Your online visit starts at @time",
}
PAYMENT_TEXTS = {
    "starts_soon": "The online visit starts soon and is not paid",
    "invoice_no_account": "Booked online, no access to payments: take the payment by link",
    "planned_account": "Booked by phone, the patient can pay online: prepare an invoice",
    "planned_no_account": "Booked by phone, no access to payments: take the payment by link",
}
COVERAGE_CASH = "cash"
COVERAGE_PREFIX = "Valid insurance: "
SURVEY_TEXT_DOCTOR = "Please review your doctor: "
SURVEY_TEXT_BRANCH = "Please leave a review: "
DEFAULT_ALERT_ORDINAL = 3
