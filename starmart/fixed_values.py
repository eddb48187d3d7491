"""Fixed values.

Everything below is part of the published result: a different spelling, order or
number here gives different rows in the marts and reports.
"""

from datetime import date, datetime

# Currencies that can be converted, and the one reported in.
KNOWN_CURRENCIES = ("USD", "EUR", "GBP")
REPORTING_CURRENCY = "USD"

# The placeholder product that collects lines without a catalogue match.
UNKNOWN_PRODUCT_ID = -1
UNKNOWN_PRODUCT_NAME = "Unknown / Unmatched Product"
UNKNOWN_PRODUCT_CATEGORY = "Unknown"

# Fixed values: (first hour, last hour, label), in sort order 1..4.
DAY_PARTS = (
    (0, 5, "Night (00-05)"),
    (6, 11, "Morning (06-11)"),
    (12, 17, "Afternoon (12-17)"),
    (18, 23, "Evening (18-23)"),
)

# Labels of the exception report.
REASON_INVALID_CURRENCY = "invalid_currency_code"
REASON_UNKNOWN_PRODUCT = "product_id_not_in_catalogue"
REASON_SEPARATOR = "; "

# The columns of the published report files.
EXPORT_COLUMNS = {
    "rpt_top_products": (
        "product_id",
        "product_name",
        "category",
        "units_sold",
        "revenue_usd",
        "rank_by_volume",
        "rank_by_revenue",
    ),
    "rpt_promo_time_of_day": ("hour_of_day", "day_part", "order_count", "revenue_usd"),
    "rpt_data_quality_exceptions": (
        "order_item_id",
        "order_id",
        "order_date",
        "product_id",
        "currency",
        "line_amount_native",
        "flag_invalid_currency_code",
        "flag_product_id_not_in_catalogue",
        "exception_reasons",
    ),
    "kpis_summary": (
        "total_revenue_usd",
        "total_units",
        "total_orders",
        "dq_exceptions",
        "total_lines",
    ),
}

# The mark of an empty target, and the calendar of the date dimension.
EMPTY_TARGET_MARK = datetime(1900, 1, 1)
CALENDAR_FIRST_DAY = date(2024, 1, 1)
CALENDAR_LAST_DAY = date(2024, 12, 31)

# The two load batches (orders up to the cutoff belong to the first).
BATCH_CUTOFF_ORDER_ID = 300
BATCH_1_LOADED_AT = datetime(2025, 1, 1, 2, 0, 0)
BATCH_2_LOADED_AT = datetime(2025, 1, 2, 2, 0, 0)
