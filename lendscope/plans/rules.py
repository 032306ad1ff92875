"""The declared data-quality rules: which check guards which column, how severely.

The value lists and bounds are fixed values of the data contract.
"""

from __future__ import annotations

from lendscope.functions.risk import (
    AGE_ABOVE,
    AGE_LIMITS,
    DPD_BUCKETS,
    INCOME_ABOVE,
    INCOME_LIMITS,
    UNKNOWN,
)
from lendscope.operators.clients import NO_HISTORY, NONE_RECENT, UNPAID
from lendscope.operators.quality import (
    ERROR,
    WARN,
    Check,
    accepted_values,
    between,
    expression,
    not_null,
    relationship,
    unique,
)
from lendscope.plans.marts import DIMENSIONS, HORIZON


# Category labels of the source files.
CONTRACTS = ["Cash loans", "Revolving loans"]
PREVIOUS_CONTRACTS = ["Cash loans", "Consumer loans", "Revolving loans"]
GENDERS = ["F", "M"]
SUITES = [
    "Children", "Family", "Group of people", "Other_A", "Other_B", "Spouse, partner",
    "Unaccompanied",
]
INCOME_TYPES = [
    "Businessman", "Commercial associate", "Maternity leave", "Pensioner", "State servant",
    "Student", "Unemployed", "Working",
]
EDUCATION = [
    "Academic degree", "Higher education", "Incomplete higher", "Lower secondary",
    "Secondary / secondary special",
]
FAMILY = [
    "Civil marriage", "Married", "Separated", "Single / not married", "Unknown", "Widow",
]
HOUSING = [
    "Co-op apartment", "House / apartment", "Municipal apartment", "Office apartment",
    "Rented apartment", "With parents",
]
OCCUPATIONS = [
    "Accountants", "Cleaning staff", "Cooking staff", "Core staff", "Drivers", "HR staff",
    "High skill tech staff", "IT staff", "Laborers", "Low-skill Laborers", "Managers",
    "Medicine staff", "Private service staff", "Realty agents", "Sales staff", "Secretaries",
    "Security staff", "Waiters/barmen staff",
]
WEEKDAYS = [
    "FRIDAY", "MONDAY", "SATURDAY", "SUNDAY", "THURSDAY", "TUESDAY", "WEDNESDAY",
]
ORGANIZATIONS = [
    "Advertising", "Agriculture", "Bank", "Business Entity Type 1", "Business Entity Type 2",
    "Business Entity Type 3", "Cleaning", "Construction", "Culture", "Electricity", "Emergency",
    "Government", "Hotel", "Housing", "Industry: type 1", "Industry: type 10", "Industry: type 11",
    "Industry: type 12", "Industry: type 13", "Industry: type 2", "Industry: type 3",
    "Industry: type 4", "Industry: type 5", "Industry: type 6", "Industry: type 7",
    "Industry: type 8", "Industry: type 9", "Insurance", "Kindergarten", "Legal Services",
    "Medicine", "Military", "Mobile", "Other", "Police", "Postal", "Realtor", "Religion",
    "Restaurant", "School", "Security", "Security Ministries", "Self-employed", "Services",
    "Telecom", "Trade: type 1", "Trade: type 2", "Trade: type 3", "Trade: type 4", "Trade: type 5",
    "Trade: type 6", "Trade: type 7", "Transport: type 1", "Transport: type 2",
    "Transport: type 3", "Transport: type 4", "University",
]
FUNDS = ["not specified", "org spec account", "reg oper account", "reg oper spec account"]
HOUSE_TYPES = ["block of flats", "specific housing", "terraced house"]
WALLS = ["Block", "Mixed", "Monolithic", "Others", "Panel", "Stone, brick", "Wooden"]
YES_NO = ["No", "Yes"]
CREDIT_STATES = ["Active", "Bad debt", "Closed", "Sold"]
CURRENCIES = ["currency 1", "currency 2", "currency 3", "currency 4"]
CREDIT_TYPES = [
    "Another type of loan", "Car loan", "Cash loan (non-earmarked)", "Consumer credit",
    "Credit card", "Interbank credit", "Loan for business development",
    "Loan for purchase of shares (margin lending)", "Loan for the purchase of equipment",
    "Loan for working capital replenishment", "Microloan", "Mobile operator loan", "Mortgage",
    "Real estate loan", "Unknown type of loan",
]
MONTHLY_STATES = ["0", "1", "2", "3", "4", "5", "C", "X"]
CARD_STATUSES = [
    "Active", "Approved", "Completed", "Demand", "Refused", "Sent proposal", "Signed",
]
POS_STATUSES = [
    "Active", "Amortized debt", "Approved", "Canceled", "Completed", "Demand",
    "Returned to the store", "Signed",
]
DECISIONS = ["Approved", "Canceled", "Refused", "Unused offer"]
PURPOSES = [
    "Building a house or an annex", "Business development", "Buying a garage",
    "Buying a holiday home / land", "Buying a home", "Buying a new car", "Buying a used car",
    "Car repairs", "Education", "Everyday expenses", "Furniture",
    "Gasification / water supply", "Hobby", "Journey", "Medicine", "Money for a third person",
    "Other", "Payments on other loans", "Purchase of electronic equipment",
    "Refusal to name the goal", "Repairs", "Urgent needs", "Wedding / gift / holiday", "XAP",
]
PAYMENT_TYPES = [
    "Cash through the bank", "Cashless from the account of the employer",
    "Non-cash from your account",
]
REJECT_REASONS = ["CLIENT", "HC", "LIMIT", "SCO", "SCOFR", "SYSTEM", "VERIF", "XAP"]
CLIENT_TYPES = ["New", "Refreshed", "Repeater"]
GOODS = [
    "Additional Service", "Animals", "Audio/Video", "Auto Accessories",
    "Clothing and Accessories", "Computers", "Construction Materials", "Consumer Electronics",
    "Direct Sales", "Education", "Fitness", "Furniture", "Gardening", "Homewares",
    "House Construction", "Insurance", "Jewelry", "Medical Supplies", "Medicine", "Mobile",
    "Office Appliances", "Other", "Photo / Cinema Equipment", "Sport and Leisure", "Tourism",
    "Vehicles", "Weapon",
]
PORTFOLIOS = ["Cards", "Cars", "Cash", "POS"]
PRODUCT_TYPES = ["walk-in", "x-sell"]
CHANNELS = [
    "AP+ (Cash loan)", "Car dealer", "Channel of corporate sales", "Contact center",
    "Country-wide", "Credit and cash offices", "Regional / Local", "Stone",
]
SELLERS = [
    "Auto technology", "Clothing", "Connectivity", "Construction", "Consumer electronics",
    "Furniture", "Industry", "Jewelry", "MLM partners", "Tourism",
]
YIELD_GROUPS = ["high", "low_action", "low_normal", "middle"]
PRODUCTS = [
    "Card Street", "Card X-Sell", "Cash", "Cash Street: high", "Cash Street: low",
    "Cash Street: middle", "Cash X-Sell: high", "Cash X-Sell: low", "Cash X-Sell: middle",
    "POS household with interest", "POS household without interest",
    "POS industry with interest", "POS industry without interest", "POS mobile with interest",
    "POS mobile without interest", "POS other with interest", "POS others without interest",
]

AGE_BANDS = [label for _, label in AGE_LIMITS] + [AGE_ABOVE, UNKNOWN]
INCOME_BANDS = [label for _, label in INCOME_LIMITS] + [INCOME_ABOVE, UNKNOWN]
BUCKETS = list(DPD_BUCKETS)

STAGING, HISTORY, MARTS, SNAPSHOT = "staging", "intermediate", "marts", "snapshot"


def _at_least_zero(table: str, columns: str, severity: str = ERROR) -> list[Check]:
    return [between(table, column, low=0, severity=severity) for column in columns.split()]


def _at_most_zero(table: str, columns: str) -> list[Check]:
    return [between(table, column, high=0, severity=WARN) for column in columns.split()]


def _rate(table: str, columns: str) -> list[Check]:
    return [between(table, column, low=0, high=1) for column in columns.split()]


def _labels(table: str, **values: list[str]) -> list[Check]:
    return [accepted_values(table, column, allowed) for column, allowed in values.items()]


def _key(table: str, column: str) -> list[Check]:
    return [unique(table, column), not_null(table, column)]


def _staging_checks() -> list[Check]:
    train, test = "stg_application_train", "stg_application_test"
    bureau, months = "stg_bureau", "stg_bureau_balance"
    cards, pos = "stg_credit_card_balance", "stg_pos_cash_balance"
    paid, previous = "stg_installments_payments", "stg_previous_application"
    hour = "hour_appr_process_start"
    return [
        *_key(train, "sk_id_curr"),
        not_null(train, "target"),
        between(train, "target", low=0, high=1, severity=WARN),
        *_labels(
            train,
            name_contract_type=CONTRACTS,
            code_gender=GENDERS,
            name_type_suite=SUITES,
            name_income_type=INCOME_TYPES,
            name_education_type=EDUCATION,
            name_family_status=FAMILY,
            name_housing_type=HOUSING,
            occupation_type=OCCUPATIONS,
            weekday_appr_process_start=WEEKDAYS,
            organization_type=ORGANIZATIONS,
            fondkapremont_mode=FUNDS,
            housetype_mode=HOUSE_TYPES,
            wallsmaterial_mode=WALLS,
            emergencystate_mode=YES_NO,
        ),
        between(train, hour, low=0, high=23, severity=WARN),
        *[between(train, f"ext_source_{n}", low=0, high=1, severity=WARN) for n in (1, 2, 3)],
        between(train, "days_birth", high=-1, severity=WARN),
        *_at_least_zero(train, "amt_income_total amt_credit", severity=WARN),
        *_key(test, "sk_id_curr"),
        *_labels(
            test,
            name_contract_type=CONTRACTS,
            code_gender=GENDERS,
            name_income_type=INCOME_TYPES,
        ),
        *_key(bureau, "sk_id_bureau"),
        not_null(bureau, "sk_id_curr"),
        *_labels(
            bureau,
            credit_active=CREDIT_STATES,
            credit_currency=CURRENCIES,
            credit_type=CREDIT_TYPES,
        ),
        *_at_most_zero(bureau, "days_credit"),
        unique(months, "sk_id_bureau", "months_balance"),
        not_null(months, "sk_id_bureau"),
        relationship(months, "sk_id_bureau", bureau, "sk_id_bureau", severity=WARN),
        not_null(months, "months_balance"),
        *_at_most_zero(months, "months_balance"),
        not_null(months, "status"),
        *_labels(months, status=MONTHLY_STATES),
        unique(cards, "sk_id_prev", "months_balance"),
        not_null(cards, "sk_id_prev"),
        relationship(cards, "sk_id_prev", previous, "sk_id_prev", severity=WARN),
        not_null(cards, "months_balance"),
        *_at_most_zero(cards, "months_balance"),
        not_null(cards, "sk_id_curr"),
        *_labels(cards, name_contract_status=CARD_STATUSES),
        *_key(paid, "installment_payment_id"),
        not_null(paid, "sk_id_prev"),
        relationship(paid, "sk_id_prev", previous, "sk_id_prev", severity=WARN),
        not_null(paid, "sk_id_curr"),
        *_at_most_zero(paid, "days_instalment days_entry_payment"),
        *_at_least_zero(paid, "amt_instalment", severity=WARN),
        unique(pos, "sk_id_prev", "months_balance"),
        not_null(pos, "sk_id_prev"),
        relationship(pos, "sk_id_prev", previous, "sk_id_prev", severity=WARN),
        not_null(pos, "months_balance"),
        *_at_most_zero(pos, "months_balance"),
        not_null(pos, "sk_id_curr"),
        *_labels(pos, name_contract_status=POS_STATUSES),
        *_key(previous, "sk_id_prev"),
        not_null(previous, "sk_id_curr"),
        *_labels(
            previous,
            name_contract_type=PREVIOUS_CONTRACTS,
            weekday_appr_process_start=WEEKDAYS,
            name_cash_loan_purpose=PURPOSES,
            name_contract_status=DECISIONS,
            name_payment_type=PAYMENT_TYPES,
            code_reject_reason=REJECT_REASONS,
            name_type_suite=SUITES,
            name_client_type=CLIENT_TYPES,
            name_goods_category=GOODS,
            name_portfolio=PORTFOLIOS,
            name_product_type=PRODUCT_TYPES,
            channel_type=CHANNELS,
            name_seller_industry=SELLERS,
            name_yield_group=YIELD_GROUPS,
            product_combination=PRODUCTS,
        ),
        between(previous, hour, low=0, high=23, severity=WARN),
        *_at_most_zero(previous, "days_decision"),
    ]


def _history_checks() -> list[Check]:
    schedule, performance = "int_installment_schedule", "int_loan_payment_performance"
    clients = "int_client_credit_history"
    return [
        *_key(schedule, "installment_id"),
        not_null(schedule, "sk_id_prev"),
        not_null(schedule, "sk_id_curr"),
        *_at_least_zero(schedule, "dpd"),
        *_labels(schedule, dpd_bucket=BUCKETS),
        *_key(performance, "sk_id_prev"),
        *_labels(performance, dpd_bucket=BUCKETS),
        *_key("int_pos_cash_loan", "sk_id_prev"),
        *_key("int_credit_card_loan", "sk_id_prev"),
        *_key("int_bureau_client", "sk_id_curr"),
        *_key(clients, "sk_id_curr"),
        *_labels(
            clients,
            worst_dpd_bucket=[*BUCKETS, NO_HISTORY],
            worst_dpd_bucket_12m=[*BUCKETS, NO_HISTORY, NONE_RECENT],
            dpd_bucket=[*BUCKETS, NO_HISTORY, UNPAID],
        ),
    ]


def _mart_checks() -> list[Check]:
    clients, loans, installments = "dim_client", "fct_loans", "fct_installments"
    risk, vintage = "mart_credit_risk", "mart_vintage_curves"
    return [
        expression(clients, "(client_source = 'train') = (is_default is not null)"),
        *_key(clients, "sk_id_curr"),
        not_null(clients, "client_source"),
        between(clients, "age_years", low=18, high=100, severity=WARN),
        *_labels(
            clients,
            client_source=["train", "test"],
            age_band=AGE_BANDS,
            income_band=INCOME_BANDS,
        ),
        *_at_least_zero(clients, "amt_income_total amt_credit"),
        *_key(loans, "sk_id_prev"),
        not_null(loans, "sk_id_curr"),
        relationship(loans, "sk_id_curr", clients, "sk_id_curr"),
        *_labels(loans, name_contract_status=DECISIONS, dpd_bucket=BUCKETS),
        *_at_least_zero(loans, "amt_application amt_credit max_dpd"),
        *_key(installments, "installment_id"),
        not_null(installments, "sk_id_prev"),
        relationship(
            installments, "sk_id_prev", loans, "sk_id_prev", only_where="has_loan_record"
        ),
        not_null(installments, "sk_id_curr"),
        relationship(installments, "sk_id_curr", clients, "sk_id_curr"),
        not_null(installments, "is_unpaid"),
        *_at_least_zero(installments, "amt_due amt_paid dpd"),
        *_labels(installments, dpd_bucket=BUCKETS),
        unique(risk, "dimension", "dimension_value"),
        expression(risk, "n_defaults <= n_clients"),
        not_null(risk, "dimension"),
        not_null(risk, "dimension_value"),
        *_labels(risk, dimension=list(DIMENSIONS)),
        between(risk, "n_clients", low=1),
        *[
            between(risk, rate, low=0, high=1)
            for rate in (
                "default_rate",
                "default_rate_ci_low",
                "default_rate_ci_high",
                "share_of_clients",
            )
        ],
        *[
            between(risk, exposure, low=0)
            for exposure in ("exposure_application_credit", "exposure_bureau_active_debt")
        ],
        unique(vintage, "cohort", "months_on_book"),
        expression(
            vintage,
            "n_loans_ever_30p <= n_loans_observable and n_loans_observable <= n_loans_in_cohort",
        ),
        not_null(vintage, "cohort"),
        not_null(vintage, "months_on_book"),
        between(vintage, "months_on_book", low=0, high=HORIZON - 1),
        between(vintage, "cumulative_30p_rate", low=0, high=1),
    ]


def _snapshot_checks() -> list[Check]:
    history = "snp_loan_status"
    return [unique(history, "sk_id_prev", "dbt_valid_from"), not_null(history, "sk_id_prev")]


CHECKS: dict[str, list[Check]] = {
    STAGING: _staging_checks(),
    HISTORY: _history_checks(),
    MARTS: _mart_checks(),
    SNAPSHOT: _snapshot_checks(),
}
