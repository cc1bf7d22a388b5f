"""Report layouts: raw column lists per report and country profile, the
columns each cleaning rule applies to, and the published output layouts.

FIXED VALUES: every name list below must equal the marketplace report
layouts for results to match, spelling included (``data_time_orignal`` is
spelled so in the published layout).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------- FIXED VALUES
# Transactions, United States: raw columns by position (30).
TXN_US_RAW = [
    "date/time", "settlement id", "type", "order id", "sku", "description",
    "quantity", "marketplace", "account type", "fulfillment", "order city",
    "order state", "order postal", "tax collection model", "product sales",
    "product sales tax", "shipping credits", "shipping credits tax",
    "gift wrap credits", "giftwrap credits tax", "Regulatory Fee",
    "Tax On Regulatory Fee", "promotional rebates", "promotional rebates tax",
    "marketplace withheld tax", "selling fees", "fba fees",
    "other transaction fees", "other", "total",
]
# Transactions, Canada: raw columns by position (29).
TXN_CA_RAW = [
    "date/time", "settlement id", "type", "order id", "sku", "description",
    "quantity", "marketplace", "fulfillment", "order city", "order state",
    "order postal", "tax collection model", "product sales",
    "product sales tax", "shipping credits", "shipping credits tax",
    "gift wrap credits", "gift wrap credits tax", "Regulatory fee",
    "Tax on regulatory fee", "promotional rebates", "promotional rebates tax",
    "marketplace withheld tax", "selling fees", "fba fees",
    "other transaction fees", "other", "total",
]
# Transactions, Mexico: raw columns by position (29).
TXN_MX_RAW = [
    "fecha/hora", "Id. de liquidación", "tipo", "Id. del pedido", "sku",
    "descripción", "cantidad", "marketplace", "cumplimiento",
    "ciudad del pedido", "estado del pedido", "código postal del pedido",
    "modelo de recaudación de impuestos", "ventas de productos",
    "impuesto de ventas de productos", "créditos de envío",
    "impuesto de abono de envío", "créditos por envoltorio de regalo",
    "impuesto de créditos de envoltura", "Tarifa reglamentaria",
    "Impuesto sobre tarifa reglamentaria", "descuentos promocionales",
    "impuesto de reembolsos promocionales",
    "impuesto de retenciones en la plataforma", "tarifas de venta",
    "tarifas fba", "tarifas de otra transacción", "otro", "total",
]
# The Mexico output layout asks for "tipo " with a trailing blank, so the
# published column is always empty; ``strict_parity=True`` reproduces that.
TXN_MX_TYPE_AS_PUBLISHED = "tipo "

# Settlement: date columns, integer columns, decimal-comma columns, the six
# candidate date formats in trial order, and the 28-column output layout.
SETTLE_DATE_COLUMNS = ["settlement-start-date", "settlement-end-date",
                       "deposit-date", "posted-date-time", "posted-date"]
SETTLE_INT_COLUMNS = ["order-item-code", "quantity-purchased"]
SETTLE_FLOAT_COLUMNS = ["amount", "total-amount"]
SETTLE_DATE_FORMATS = ["%d-%m-%Y %H:%M:%S", "%m-%d-%Y %H:%M:%S",
                       "%Y-%m-%d %H:%M:%S", "%Y-%d-%m %H:%M:%S",
                       "%Y-%m-%d", "%d-%m-%Y"]
SETTLE_OUT = [
    "settlement-id", "settlement-start-date", "settlement-end-date",
    "deposit-date", "total-amount", "currency", "transaction-type",
    "order-id", "merchant-order-id", "adjustment-id", "shipment-id",
    "marketplace-name", "amount-type", "amount-description", "amount",
    "fulfillment-id", "posted-date", "original_posted_date_time",
    "order-item-code", "merchant-order-item-id",
    "merchant-adjustment-item-id", "sku", "quantity-purchased",
    "promotion-id", "report_type", "run_date", "filename",
    "posted_date_time_pst",
]
# Output columns 2-6 (settlement-start-date .. currency) carry the value of
# the file's first row on every row.
SETTLE_FILL_FROM_FIRST = SETTLE_OUT[1:6]
SETTLE_REPORT_TYPE = "Marketplace Impact"

# Inventory ledger: 21 data columns plus the source file name (22).
INVENTORY_OUT = [
    "Date", "FNSKU", "ASIN", "MSKU", "Title", "Disposition",
    "Starting Warehouse Balance", "In Transit Between Warehouses", "Receipts",
    "Customer Shipments", "Customer Returns", "Vendor Returns",
    "Warehouse Transfer In/Out", "Found", "Lost", "Damaged", "Disposed",
    "Other Events", "Ending Warehouse Balance", "Unknown Events", "Location",
    "file_name",
]

# Sales and traffic: 36 flattened data columns and 4 added ones (40).
TRAFFIC_OUT = [
    "parentAsin", "childAsin", "trafficByAsin.mobileAppSessions",
    "trafficByAsin.mobileAppSessionsB2B", "trafficByAsin.browserSessions",
    "trafficByAsin.browserSessionsB2B", "trafficByAsin.sessions",
    "trafficByAsin.sessionsB2B", "trafficByAsin.mobileAppSessionPercentage",
    "trafficByAsin.mobileAppSessionPercentageB2B",
    "trafficByAsin.browserSessionPercentage",
    "trafficByAsin.browserSessionPercentageB2B",
    "trafficByAsin.sessionPercentage", "trafficByAsin.sessionPercentageB2B",
    "trafficByAsin.mobileAppPageViews", "trafficByAsin.mobileAppPageViewsB2B",
    "trafficByAsin.browserPageViews", "trafficByAsin.browserPageViewsB2B",
    "trafficByAsin.pageViews", "trafficByAsin.pageViewsB2B",
    "trafficByAsin.mobileAppPageViewsPercentage",
    "trafficByAsin.mobileAppPageViewsPercentageB2B",
    "trafficByAsin.browserPageViewsPercentage",
    "trafficByAsin.browserPageViewsPercentageB2B",
    "trafficByAsin.pageViewsPercentage", "trafficByAsin.pageViewsPercentageB2B",
    "trafficByAsin.buyBoxPercentage", "trafficByAsin.buyBoxPercentageB2B",
    "salesByAsin.unitsOrdered", "salesByAsin.unitsOrderedB2B",
    "trafficByAsin.unitSessionPercentage",
    "trafficByAsin.unitSessionPercentageB2B",
    "salesByAsin.orderedProductSales.amount",
    "salesByAsin.orderedProductSalesB2B.amount",
    "salesByAsin.totalOrderItems", "salesByAsin.totalOrderItemsB2B",
    "year", "file_date", "file_name", "run_date",
]
# The 15 percentage columns that get a '%' suffix; the B2B browser-session
# percentage is not among them in the published report.
TRAFFIC_PERCENT = [
    "trafficByAsin.mobileAppSessionPercentage",
    "trafficByAsin.mobileAppSessionPercentageB2B",
    "trafficByAsin.browserSessionPercentage",
    "trafficByAsin.sessionPercentage",
    "trafficByAsin.sessionPercentageB2B",
    "trafficByAsin.mobileAppPageViewsPercentage",
    "trafficByAsin.mobileAppPageViewsPercentageB2B",
    "trafficByAsin.browserPageViewsPercentage",
    "trafficByAsin.browserPageViewsPercentageB2B",
    "trafficByAsin.pageViewsPercentage",
    "trafficByAsin.pageViewsPercentageB2B",
    "trafficByAsin.buyBoxPercentage",
    "trafficByAsin.buyBoxPercentageB2B",
    "trafficByAsin.unitSessionPercentage",
    "trafficByAsin.unitSessionPercentageB2B",
]

# Listings: the modified file (9) and the de-duplicated file (7).
LISTING_MOD = ["seller-sku", "asin1", "item-name", "price", "quantity",
               "product-id", "fulfillment-channel", "status", "run_date"]
LISTING_DEDUP = ["seller-sku", "asin1", "product-id", "fulfillment-channel",
                 "status", "active_flag", "run_date"]

# Report catalogue: the 10 columns kept from a listing page.
CATALOGUE = ["reportType", "processingStartTime", "processingEndTime",
             "dataStartTime", "dataEndTime", "createdTime",
             "processingStatus", "marketplaceIds", "reportDocumentId",
             "reportId"]

# Job health: completion record, expected-jobs list, pending output.
COMPLETION = ["scriptname", "freq", "process", "server", "starttime",
              "endtime", "total_completion_time"]
EXPECTED = ["scriptname", "frequency", "schedule_time", "ETA", "scriptpath"]
PENDING = ["scriptname", "schedule_time", "frequency", "scriptpath"]
# Interval jobs: frequency and the hours after which a job is overdue.
OVERDUE_HOURS = [("6hour", 7), ("3hour", 3), ("2hour", 2), ("hourly", 2),
                 ("30min", 2), ("10min", 2)]
DAILY_PATTERN = "daily|weekly"
INTERVAL_GATE = "02:05"          # interval checks run only after this time
QUIET_MESSAGE_TIMES = ["07:15", "23:15"]
NO_PENDING_MESSAGE = "No pending script as of now."
PENDING_MESSAGE_HEAD = ("Pending script list :\n\n"
                        "scriptname---schedule_time---frequency---scriptpath\n\n")
PENDING_LINE_SEP = "  \n"
PENDING_FIELD_SEP = "---"

# Metric alert: enter above 90 (strict), leave at or below 79, remind every
# 60 samples while still high.
ALERT_ABOVE = 90.0
NORMAL_AT_OR_BELOW = 79.0
REMIND_EVERY = 60

# Spanish month tokens and their English names, in the order applied.
SPANISH_MONTHS = [
    ("ene", "January"), ("feb", "February"), ("marzo", "March"),
    ("abr", "April"), ("mayo", "May"), ("jun", "June"), ("jul", "July"),
    ("ago", "August"), ("sept", "September"), ("oct", "October"),
    ("nov", "November"), ("dic", "December"),
]

# Base names of the traffic report's counts and percentages.
TRAFFIC_INT_FIELDS = ["mobileAppSessions", "browserSessions", "sessions", "mobileAppPageViews",
               "browserPageViews", "pageViews"]
TRAFFIC_PERCENT_FIELDS = ["mobileAppSessionPercentage", "browserSessionPercentage", "sessionPercentage",
               "mobileAppPageViewsPercentage", "browserPageViewsPercentage", "pageViewsPercentage",
               "buyBoxPercentage", "unitSessionPercentage"]

# Delimiters considered when a file's delimiter is not known.
DELIMITER_CANDIDATES = [",", "\t", ";", "|"]
DELIMITER_SAMPLE_CHARS = 5012
PACIFIC = "America/Los_Angeles"
# -------------------------------------------------------------- END FIXED VALUES


def string_schema(names: list[str]) -> StructType:
    """All-string schema: raw report fields are read as text and cast by rule."""
    return StructType([StructField(n, StringType(), True) for n in names])


@dataclass(frozen=True)
class TxnProfile:
    """Country profile of a transaction report (header, roles, layout)."""

    country: str
    raw: list[str]
    date_col: str
    id_cols: list[str]
    money_cols: list[str]
    out: list[str] = field(default_factory=list)


def _txn_profile(country: str, raw: list[str], type_col_out: str | None = None) -> TxnProfile:
    date_col = raw[0]
    id_cols = [c for c in raw if c in (
        "order postal", "settlement id", "código postal del pedido",
        "Id. de liquidación")]
    money_from = raw.index("product sales") if "product sales" in raw else raw.index(
        "ventas de productos")
    money = raw[money_from:]
    body = list(raw[1:])
    if type_col_out is not None:
        body[body.index("tipo")] = type_col_out
    out = ["data_time_orignal", *body, "file_name", "run_date", "date_time_pst"]
    return TxnProfile(country, raw, date_col, id_cols, money, out)


TXN_PROFILES = {
    "US": _txn_profile("US", TXN_US_RAW),
    "CA": _txn_profile("CA", TXN_CA_RAW),
    "MX": _txn_profile("MX", TXN_MX_RAW),
}
TXN_MX_STRICT = _txn_profile("MX", TXN_MX_RAW, TXN_MX_TYPE_AS_PUBLISHED)
