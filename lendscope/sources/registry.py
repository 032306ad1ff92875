"""The eight source tables: file, grain, required columns, staging types.

The lists are fixed values of the data contract (column names and their types).
Repetitive families (building features, document flags) come from a rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

BIGINT = "bigint"
DAY_OR_SENTINEL = "day_or_sentinel"
MONEY = "money"
DOUBLE = "double"
FLAG_01 = "flag_01"
FLAG_YN = "flag_yn"
TEXT = "text"
CODE = "code"

AUDIT_COLUMNS = ("_loaded_at", "_source_file")


@dataclass(frozen=True)
class SourceTable:
    name: str
    file_name: str
    grain: tuple[str, ...]
    required: tuple[str, ...]
    types: dict[str, str] = field(hash=False)
    row_key: str | None = None  # name of the surrogate key when the grain is not unique

    @property
    def columns(self) -> list[str]:
        return list(self.types)


def _typed(**groups: tuple[str, ...]) -> dict[str, str]:
    return {name: kind for kind, names in groups.items() for name in names}


# Columns of the source files, by type.
_APPLICATION = _typed(
    bigint=(
        "sk_id_curr", "target", "cnt_children", "days_birth", "days_id_publish", "own_car_age",
        "cnt_fam_members", "region_rating_client", "region_rating_client_w_city",
        "hour_appr_process_start", "obs_30_cnt_social_circle", "def_30_cnt_social_circle",
        "obs_60_cnt_social_circle", "def_60_cnt_social_circle", "days_last_phone_change",
        "amt_req_credit_bureau_hour", "amt_req_credit_bureau_day", "amt_req_credit_bureau_week",
        "amt_req_credit_bureau_mon", "amt_req_credit_bureau_qrt", "amt_req_credit_bureau_year",
    ),
    day_or_sentinel=(
        "days_employed",
    ),
    money=(
        "amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price",
    ),
    double=(
        "region_population_relative", "days_registration", "ext_source_1", "ext_source_2",
        "ext_source_3", "totalarea_mode", "apartments_avg", "basementarea_avg",
        "years_beginexpluatation_avg", "years_build_avg", "commonarea_avg", "elevators_avg",
        "entrances_avg", "floorsmax_avg", "floorsmin_avg", "landarea_avg", "livingapartments_avg",
        "livingarea_avg", "nonlivingapartments_avg", "nonlivingarea_avg", "apartments_mode",
        "basementarea_mode", "years_beginexpluatation_mode", "years_build_mode", "commonarea_mode",
        "elevators_mode", "entrances_mode", "floorsmax_mode", "floorsmin_mode", "landarea_mode",
        "livingapartments_mode", "livingarea_mode", "nonlivingapartments_mode",
        "nonlivingarea_mode", "apartments_medi", "basementarea_medi",
        "years_beginexpluatation_medi", "years_build_medi", "commonarea_medi", "elevators_medi",
        "entrances_medi", "floorsmax_medi", "floorsmin_medi", "landarea_medi",
        "livingapartments_medi", "livingarea_medi", "nonlivingapartments_medi",
        "nonlivingarea_medi",
    ),
    flag_01=(
        "flag_mobil", "flag_emp_phone", "flag_work_phone", "flag_cont_mobile", "flag_phone",
        "flag_email", "reg_region_not_live_region", "reg_region_not_work_region",
        "live_region_not_work_region", "reg_city_not_live_city", "reg_city_not_work_city",
        "live_city_not_work_city", "flag_document_2", "flag_document_3", "flag_document_4",
        "flag_document_5", "flag_document_6", "flag_document_7", "flag_document_8",
        "flag_document_9", "flag_document_10", "flag_document_11", "flag_document_12",
        "flag_document_13", "flag_document_14", "flag_document_15", "flag_document_16",
        "flag_document_17", "flag_document_18", "flag_document_19", "flag_document_20",
        "flag_document_21",
    ),
    flag_yn=(
        "flag_own_car", "flag_own_realty",
    ),
    text=(
        "name_contract_type", "name_type_suite", "name_income_type", "name_education_type",
        "name_family_status", "name_housing_type", "occupation_type", "weekday_appr_process_start",
        "fondkapremont_mode", "housetype_mode", "wallsmaterial_mode", "emergencystate_mode",
    ),
    code=(
        "code_gender", "organization_type",
    ),
)

TABLES: tuple[SourceTable, ...] = (
    SourceTable(
        "application_train",
        "application_train.csv",
        ("sk_id_curr",),
        ("sk_id_curr", "target"),
        _APPLICATION,
    ),
    SourceTable(
        "application_test",
        "application_test.csv",
        ("sk_id_curr",),
        ("sk_id_curr",),
        {name: kind for name, kind in _APPLICATION.items() if name != "target"},
    ),
    SourceTable(
        "bureau",
        "bureau.csv",
        ("sk_id_bureau",),
        ("sk_id_curr", "sk_id_bureau"),
        _typed(
            bigint=(
                "sk_id_curr", "sk_id_bureau", "days_credit", "credit_day_overdue",
                "days_credit_enddate", "days_enddate_fact", "cnt_credit_prolong",
                "days_credit_update",
            ),
            money=(
                "amt_credit_max_overdue", "amt_credit_sum", "amt_credit_sum_debt",
                "amt_credit_sum_limit", "amt_credit_sum_overdue", "amt_annuity",
            ),
            text=(
                "credit_active", "credit_currency", "credit_type",
            ),
        ),
    ),
    SourceTable(
        "bureau_balance",
        "bureau_balance.csv",
        ("sk_id_bureau", "months_balance"),
        ("sk_id_bureau", "months_balance", "status"),
        _typed(
            bigint=(
                "sk_id_bureau", "months_balance",
            ),
            text=(
                "status",
            ),
        ),
    ),
    SourceTable(
        "previous_application",
        "previous_application.csv",
        ("sk_id_prev",),
        ("sk_id_prev", "sk_id_curr"),
        _typed(
            bigint=(
                "sk_id_prev", "sk_id_curr", "hour_appr_process_start", "days_decision",
                "sellerplace_area", "cnt_payment",
            ),
            day_or_sentinel=(
                "days_first_drawing", "days_first_due", "days_last_due_1st_version",
                "days_last_due", "days_termination",
            ),
            money=(
                "amt_annuity", "amt_application", "amt_credit", "amt_down_payment",
                "amt_goods_price",
            ),
            double=(
                "rate_down_payment", "rate_interest_primary", "rate_interest_privileged",
            ),
            flag_01=(
                "nflag_last_appl_in_day", "nflag_insured_on_approval",
            ),
            flag_yn=(
                "flag_last_appl_per_contract",
            ),
            text=(
                "weekday_appr_process_start", "name_contract_status", "name_type_suite",
                "channel_type", "product_combination",
            ),
            code=(
                "name_contract_type", "name_cash_loan_purpose", "name_payment_type",
                "code_reject_reason", "name_client_type", "name_goods_category", "name_portfolio",
                "name_product_type", "name_seller_industry", "name_yield_group",
            ),
        ),
    ),
    SourceTable(
        "installments_payments",
        "installments_payments.csv",
        (),
        ("sk_id_prev", "sk_id_curr"),
        # The key hashes the columns in this order.
        {
            "sk_id_prev": BIGINT,
            "sk_id_curr": BIGINT,
            "num_instalment_version": BIGINT,
            "num_instalment_number": BIGINT,
            "days_instalment": BIGINT,
            "days_entry_payment": BIGINT,
            "amt_instalment": MONEY,
            "amt_payment": MONEY,
        },
        row_key="installment_payment_id",
    ),
    SourceTable(
        "pos_cash_balance",
        "POS_CASH_balance.csv",
        ("sk_id_prev", "months_balance"),
        ("sk_id_prev", "sk_id_curr", "months_balance"),
        _typed(
            bigint=(
                "sk_id_prev", "sk_id_curr", "months_balance", "cnt_instalment",
                "cnt_instalment_future", "sk_dpd", "sk_dpd_def",
            ),
            code=(
                "name_contract_status",
            ),
        ),
    ),
    SourceTable(
        "credit_card_balance",
        "credit_card_balance.csv",
        ("sk_id_prev", "months_balance"),
        ("sk_id_prev", "sk_id_curr", "months_balance"),
        _typed(
            bigint=(
                "sk_id_prev", "sk_id_curr", "months_balance", "cnt_drawings_atm_current",
                "cnt_drawings_current", "cnt_drawings_other_current", "cnt_drawings_pos_current",
                "cnt_instalment_mature_cum", "sk_dpd", "sk_dpd_def",
            ),
            money=(
                "amt_balance", "amt_credit_limit_actual", "amt_drawings_atm_current",
                "amt_drawings_current", "amt_drawings_other_current", "amt_drawings_pos_current",
                "amt_inst_min_regularity", "amt_payment_current", "amt_payment_total_current",
                "amt_receivable_principal", "amt_recivable", "amt_total_receivable",
            ),
            text=(
                "name_contract_status",
            ),
        ),
    ),
)

TABLES_BY_NAME = {table.name: table for table in TABLES}
