"""Fixed values of the loan domain: file and column names, codes, dates, hints and rules.

Everything here is data that results depend on, spelled as the source files and the published
tables spell it. No logic lives in this module beyond assembling rule lists.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from typing import NamedTuple

# ---- fixed values: dates, sentinels, tokens, thresholds ----------------------------------------

ANCHOR_DAY = date(2018, 5, 1)
LAST_OBSERVED_DAY_OFFSET = -1

DAYS_UNKNOWN = 365243
SELLING_AREA_UNKNOWN = -1
BLANK_TOKENS = ("XNA", "XAP")

AMOUNT = "DECIMAL(18,3)"

DEFAULT_FROM_DAYS = 90
DPD_EDGES = ((0, "0"), (1, "1-29"), (30, "30-59"), (60, "60-89"), (90, "90+"))

BUREAU_HIGHEST_BUCKET = 5
BUREAU_DEFAULT_FROM_BUCKET = 4
BUREAU_CLOSED = "C"
BUREAU_UNKNOWN = "X"

OPEN_STATUSES = ("Active", "Signed", "Demand")
POS_CASH = "pos_cash"
CREDIT_CARD = "credit_card"

SERIES_LAG_MONTHS = {"hicp_yoy": 1, "unemployment_rate": 2, "euribor_3m": 0}
SERIES_PREFIX = "macro_"

REPLAY_MODULUS = 5000
REPLAY_BATCH_ROWS = 200

CORRECTION_FACTOR = "1.1"
MARRIED = "Married"
NOT_MARRIED = "Single / not married"

DELIVERY_COLUMNS = ("_rescued_data", "_ingested_at", "_source_file")
VALID_FROM = "__START_AT"
VALID_TO = "__END_AT"

# ---- fixed values: source files ----------------------------------------------------------------

SOURCE_FILES = {
    "application_train": "application_train.csv",
    "application_test": "application_test.csv",
    "bureau": "bureau.csv",
    "bureau_balance": "bureau_balance.csv",
    "previous_application": "previous_application.csv",
    "pos_cash_balance": "POS_CASH_balance.csv",
    "credit_card_balance": "credit_card_balance.csv",
    "installments_payments": "installments_payments.csv",
}

# ---- fixed values: column types pinned at ingestion (DDL; all other types are inferred) --------

TYPE_HINTS = {
    "application_train": (
        "SK_ID_CURR BIGINT, TARGET INT, AMT_INCOME_TOTAL DOUBLE, AMT_CREDIT DOUBLE, "
        "AMT_ANNUITY DOUBLE, AMT_GOODS_PRICE DOUBLE"
    ),
    "application_test": (
        "SK_ID_CURR BIGINT, AMT_INCOME_TOTAL DOUBLE, AMT_CREDIT DOUBLE, AMT_ANNUITY DOUBLE, "
        "AMT_GOODS_PRICE DOUBLE"
    ),
    "bureau": (
        "SK_ID_CURR BIGINT, SK_ID_BUREAU BIGINT, AMT_CREDIT_MAX_OVERDUE DOUBLE, "
        "AMT_CREDIT_SUM DOUBLE, AMT_CREDIT_SUM_DEBT DOUBLE, AMT_CREDIT_SUM_LIMIT DOUBLE, "
        "AMT_CREDIT_SUM_OVERDUE DOUBLE, AMT_ANNUITY DOUBLE"
    ),
    "bureau_balance": "SK_ID_BUREAU BIGINT, MONTHS_BALANCE INT, STATUS STRING",
    "previous_application": (
        "SK_ID_PREV BIGINT, SK_ID_CURR BIGINT, AMT_ANNUITY DOUBLE, AMT_APPLICATION DOUBLE, "
        "AMT_CREDIT DOUBLE, AMT_DOWN_PAYMENT DOUBLE, AMT_GOODS_PRICE DOUBLE"
    ),
    "pos_cash_balance": (
        "SK_ID_PREV BIGINT, SK_ID_CURR BIGINT, MONTHS_BALANCE INT, SK_DPD INT, SK_DPD_DEF INT"
    ),
    "credit_card_balance": (
        "SK_ID_PREV BIGINT, SK_ID_CURR BIGINT, MONTHS_BALANCE INT, AMT_BALANCE DOUBLE, "
        "AMT_CREDIT_LIMIT_ACTUAL DOUBLE, AMT_DRAWINGS_ATM_CURRENT DOUBLE, "
        "AMT_DRAWINGS_CURRENT DOUBLE, AMT_DRAWINGS_OTHER_CURRENT DOUBLE, "
        "AMT_DRAWINGS_POS_CURRENT DOUBLE, AMT_INST_MIN_REGULARITY DOUBLE, "
        "AMT_PAYMENT_CURRENT DOUBLE, AMT_PAYMENT_TOTAL_CURRENT DOUBLE, "
        "AMT_RECEIVABLE_PRINCIPAL DOUBLE, AMT_RECIVABLE DOUBLE, AMT_TOTAL_RECEIVABLE DOUBLE, "
        "SK_DPD INT, SK_DPD_DEF INT"
    ),
    "installments_payments": (
        "SK_ID_PREV BIGINT, SK_ID_CURR BIGINT, NUM_INSTALMENT_VERSION DOUBLE, "
        "NUM_INSTALMENT_NUMBER INT, DAYS_INSTALMENT DOUBLE, DAYS_ENTRY_PAYMENT DOUBLE, "
        "AMT_INSTALMENT DOUBLE, AMT_PAYMENT DOUBLE"
    ),
    "series": "KEY STRING, TIME_PERIOD STRING, OBS_VALUE DOUBLE, OBS_STATUS STRING",
}

# ---- fixed values: cleaned tables --------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """How one cleaned table is made from its raw tables (arguments of ``plans.entities``)."""

    raw: tuple[str, ...]
    key: tuple[str, ...]
    cluster_by: tuple[str, ...]
    longs: tuple[str, ...]
    ints: tuple[str, ...]
    amounts: tuple[str, ...] = ()
    strings: tuple[str, ...] = ()
    blank_tokens: bool = True
    renames: dict[str, str] = field(default_factory=dict)
    sentinels: dict[str, int] = field(default_factory=dict)
    day_columns: dict[str, str] = field(default_factory=dict)
    month_offset: str | None = None
    status: str | None = None
    source_flag: str | None = None
    leading: tuple[str, ...] = ()
    parent: tuple[str, str, str] | None = None  # table, key, flag column


_PARENT_CONTRACT = ("previous_application", "sk_id_prev", "has_previous_application")
_SCHEDULE_DAYS = (
    "days_first_drawing",
    "days_first_due",
    "days_last_due_1st_version",
    "days_last_due",
    "days_termination",
)

TABLES = {
    "application": TableSpec(
        raw=("application_train", "application_test"),
        key=("sk_id_curr",),
        cluster_by=("sk_id_curr",),
        longs=("sk_id_curr",),
        amounts=("amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price"),
        ints=(
            "target",
            "cnt_children",
            "cnt_fam_members",
            "days_birth",
            "days_employed",
            "days_id_publish",
        ),
        sentinels={"days_employed": DAYS_UNKNOWN},
        source_flag="is_train",
        leading=("sk_id_curr", "is_train", "target"),
    ),
    "bureau": TableSpec(
        raw=("bureau",),
        key=("sk_id_bureau",),
        cluster_by=("sk_id_curr",),
        longs=("sk_id_curr", "sk_id_bureau"),
        amounts=(
            "amt_credit_max_overdue",
            "amt_credit_sum",
            "amt_credit_sum_debt",
            "amt_credit_sum_limit",
            "amt_credit_sum_overdue",
            "amt_annuity",
        ),
        ints=(
            "days_credit",
            "credit_day_overdue",
            "days_credit_enddate",
            "days_enddate_fact",
            "days_credit_update",
            "cnt_credit_prolong",
        ),
        day_columns={
            "credit_date": "days_credit",
            "credit_end_date": "days_credit_enddate",
            "credit_end_fact_date": "days_enddate_fact",
            "credit_update_date": "days_credit_update",
        },
    ),
    "bureau_balance": TableSpec(
        raw=("bureau_balance",),
        key=("sk_id_bureau", "months_balance"),
        cluster_by=("sk_id_bureau", "month"),
        longs=("sk_id_bureau",),
        ints=("months_balance",),
        strings=("status",),
        blank_tokens=False,
        month_offset="months_balance",
        status="status",
        parent=("bureau", "sk_id_bureau", "has_bureau_record"),
    ),
    "previous_application": TableSpec(
        raw=("previous_application",),
        key=("sk_id_prev",),
        cluster_by=("sk_id_curr",),
        longs=("sk_id_prev", "sk_id_curr"),
        amounts=(
            "amt_annuity",
            "amt_application",
            "amt_credit",
            "amt_down_payment",
            "amt_goods_price",
        ),
        ints=(
            "days_decision",
            *_SCHEDULE_DAYS,
            "sellerplace_area",
            "cnt_payment",
            "hour_appr_process_start",
            "nflag_last_appl_in_day",
            "nflag_insured_on_approval",
        ),
        sentinels={
            **dict.fromkeys(_SCHEDULE_DAYS, DAYS_UNKNOWN),
            "sellerplace_area": SELLING_AREA_UNKNOWN,
        },
        day_columns={"decision_date": "days_decision"},
    ),
    "pos_cash_balance": TableSpec(
        raw=("pos_cash_balance",),
        key=("sk_id_prev", "months_balance"),
        cluster_by=("sk_id_curr", "month"),
        longs=("sk_id_prev", "sk_id_curr"),
        ints=("months_balance", "cnt_instalment", "cnt_instalment_future", "sk_dpd", "sk_dpd_def"),
        month_offset="months_balance",
        parent=_PARENT_CONTRACT,
    ),
    "credit_card_balance": TableSpec(
        raw=("credit_card_balance",),
        key=("sk_id_prev", "months_balance"),
        cluster_by=("sk_id_curr", "month"),
        longs=("sk_id_prev", "sk_id_curr"),
        amounts=(
            "amt_balance",
            "amt_credit_limit_actual",
            "amt_drawings_atm_current",
            "amt_drawings_current",
            "amt_drawings_other_current",
            "amt_drawings_pos_current",
            "amt_inst_min_regularity",
            "amt_payment_current",
            "amt_payment_total_current",
            "amt_receivable_principal",
            "amt_receivable",
            "amt_total_receivable",
        ),
        ints=(
            "months_balance",
            "cnt_drawings_atm_current",
            "cnt_drawings_current",
            "cnt_drawings_other_current",
            "cnt_drawings_pos_current",
            "cnt_instalment_mature_cum",
            "sk_dpd",
            "sk_dpd_def",
        ),
        renames={"amt_recivable": "amt_receivable"},
        month_offset="months_balance",
        parent=_PARENT_CONTRACT,
    ),
    "installments_payments": TableSpec(
        raw=("installments_payments",),
        key=(),  # no key narrower than the whole business row
        cluster_by=("sk_id_curr", "sk_id_prev"),
        longs=("sk_id_prev", "sk_id_curr"),
        amounts=("amt_instalment", "amt_payment"),
        ints=(
            "num_instalment_version",
            "num_instalment_number",
            "days_instalment",
            "days_entry_payment",
        ),
        blank_tokens=False,
        day_columns={
            "instalment_date": "days_instalment",
            "entry_payment_date": "days_entry_payment",
        },
        parent=_PARENT_CONTRACT,
    ),
}

SERIES_KEY = ("series", "time_period")
SERIES_CLUSTER_BY = ("series", "period_month")
HISTORY_KEYS = {"application": "sk_id_curr", "previous_application": "sk_id_prev"}

# ---- fixed values: quality rules (name, action, SQL condition) ---------------------------------


class Rule(NamedTuple):
    """A named SQL condition. ``action``: fail stops, drop quarantines, warn only counts."""

    name: str
    action: str
    condition: str


def _present(*columns: str) -> list[Rule]:
    return [Rule(f"{c}_not_null", "fail", f"{c} IS NOT NULL") for c in columns]


_FITS = Rule("no_rescued_data", "drop", "_rescued_data IS NULL")
_MONTH_PAST = Rule("months_balance_not_positive", "drop", "coalesce(months_balance, 1) <= 0")
_DPD_SIGN = Rule(
    "sk_dpd_not_negative", "drop", "coalesce(sk_dpd, 0) >= 0 AND coalesce(sk_dpd_def, 0) >= 0"
)
_HAS_CONTRACT = Rule("previous_application_exists", "warn", "has_previous_application")
_DPD_ORDER = Rule("sk_dpd_def_not_above_sk_dpd", "warn", "sk_dpd_def <= sk_dpd")
_EXPOSURE = Rule(
    "exposure_amount_not_negative", "warn", "exposure_amount IS NULL OR exposure_amount >= 0"
)
_PART_OF_CONTRACT = "num_instalment_number IS NOT NULL AND num_instalment_version IS NOT NULL"
_ALL_SERIES = " AND ".join(f"{SERIES_PREFIX}{name} IS NOT NULL" for name in SERIES_LAG_MONTHS)

RULES: dict[str, list[Rule]] = {
    "application": [
        *_present("sk_id_curr"),
        Rule(
            "target_matches_is_train",
            "fail",
            "(is_train AND target IN (0, 1)) OR (NOT is_train AND target IS NULL)",
        ),
        _FITS,
        Rule("amt_credit_positive", "warn", "amt_credit > 0"),
        Rule("amt_income_total_positive", "warn", "amt_income_total > 0"),
        Rule("days_birth_negative", "warn", "days_birth < 0"),
    ],
    "bureau": [
        *_present("sk_id_bureau", "sk_id_curr"),
        _FITS,
        Rule("days_credit_not_positive", "warn", "days_credit <= 0"),
        Rule(
            "days_credit_enddate_plausible",
            "warn",
            "days_credit_enddate IS NULL OR days_credit_enddate BETWEEN -20000 AND 20000",
        ),
        Rule(
            "amt_credit_sum_not_negative", "warn", "amt_credit_sum IS NULL OR amt_credit_sum >= 0"
        ),
        Rule(
            "amt_credit_sum_debt_not_negative",
            "warn",
            "amt_credit_sum_debt IS NULL OR amt_credit_sum_debt >= 0",
        ),
    ],
    "bureau_balance": [
        *_present("sk_id_bureau", "months_balance"),
        _FITS,
        _MONTH_PAST,
        Rule(
            "status_in_domain",
            "drop",
            "coalesce(status IN ('0', '1', '2', '3', '4', '5', 'C', 'X'), false)",
        ),
        Rule("bureau_record_exists", "warn", "has_bureau_record"),
    ],
    "previous_application": [
        *_present("sk_id_prev", "sk_id_curr"),
        _FITS,
        Rule(
            "approved_amt_credit_positive",
            "warn",
            "name_contract_status IS DISTINCT FROM 'Approved' OR amt_credit > 0",
        ),
        Rule("days_decision_negative", "warn", "days_decision < 0"),
        Rule(
            "amt_down_payment_not_negative",
            "warn",
            "amt_down_payment IS NULL OR amt_down_payment >= 0",
        ),
    ],
    "pos_cash_balance": [
        *_present("sk_id_prev", "sk_id_curr", "months_balance"),
        _FITS,
        _MONTH_PAST,
        _DPD_SIGN,
        _HAS_CONTRACT,
        _DPD_ORDER,
    ],
    "credit_card_balance": [
        *_present("sk_id_prev", "sk_id_curr", "months_balance"),
        _FITS,
        _MONTH_PAST,
        _DPD_SIGN,
        _HAS_CONTRACT,
        _DPD_ORDER,
        Rule("amt_balance_not_negative", "warn", "amt_balance IS NULL OR amt_balance >= 0"),
    ],
    "installments_payments": [
        *_present("sk_id_prev", "sk_id_curr"),
        _FITS,
        Rule(
            "instalment_identified", "drop", f"{_PART_OF_CONTRACT} AND days_instalment IS NOT NULL"
        ),
        _HAS_CONTRACT,
        Rule("amt_instalment_positive", "warn", "amt_instalment > 0"),
        Rule(
            "payment_recorded", "warn", "days_entry_payment IS NOT NULL AND amt_payment IS NOT NULL"
        ),
    ],
    "macro_observation": [
        *_present("series"),
        _FITS,
        Rule("period_month_parsed", "drop", "period_month IS NOT NULL"),
        Rule("obs_value_present", "drop", "obs_value IS NOT NULL"),
        Rule("obs_value_plausible", "warn", "obs_value BETWEEN -10 AND 30"),
    ],
    "installments": [
        *_present("sk_id_prev", "sk_id_curr"),
        Rule(
            "instalment_identified", "fail", f"{_PART_OF_CONTRACT} AND instalment_date IS NOT NULL"
        ),
        Rule("instalment_paid_in_full", "warn", "is_paid_in_full"),
        Rule("amt_paid_not_above_instalment", "warn", "amt_paid <= amt_instalment"),
    ],
    "contract_month": [
        *_present("sk_id_prev", "sk_id_curr", "month", "dpd"),
        _HAS_CONTRACT,
        _EXPOSURE,
        Rule(
            "installment_dpd_default_matches_source",
            "warn",
            "installment_dpd IS NULL OR source_dpd IS NULL "
            "OR (installment_dpd >= 90) = (source_dpd >= 90)",
        ),
    ],
    "client_month": [
        *_present("sk_id_curr", "month"),
        Rule(
            "default_flag_matches_max_dpd", "fail", "default_flag = coalesce(max_dpd >= 90, false)"
        ),
        Rule(
            "default_start_month_matches_flag",
            "fail",
            "default_flag = (default_start_month IS NOT NULL) "
            "AND coalesce(default_start_month <= month, true)",
        ),
        _EXPOSURE,
        Rule("macro_columns_present", "warn", _ALL_SERIES),
    ],
    "macro_month": [
        *_present("month"),
        Rule("macro_values_present", "warn", _ALL_SERIES),
    ],
}
