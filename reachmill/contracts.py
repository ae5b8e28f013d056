"""Names and schemas that stored data has to agree on.

Fixed values: folder names, table names, column names and JSON field names are
part of the data contract and are kept exactly as producers and readers use them.
"""

# ---- lake folders -------------------------------------------------------
LANDING, BRONZE, SILVER, GOLD = "landing", "bronze", "silver", "gold"

# ---- datasets per layer -------------------------------------------------
SALES = "ventas"
SNAPSHOTS = "meta_ads"

SILVER_SALES = "ventas_diarias"
SILVER_SNAPSHOTS = "meta_ads"
SILVER_SPEND = "ad_spend"

GOLD_REACH = "gold_demographic_reach"
GOLD_AD_DAILY = "gold_ad_daily_metrics"
GOLD_AD_TOTAL = "gold_ad_total_metrics"
GOLD_SATURATION = "gold_saturation_curve"

# ---- relational source tables -------------------------------------------
SQL_SPEND = "daily_spend"
SQL_MAPPING = "ad_product_mapping"
SQL_PRODUCTS = "products"

# ---- date partition columns ---------------------------------------------
DATE_PARTS = ("anio", "mes", "dia")

# ---- landing JSON -------------------------------------------------------
SALE_FIELDS = {
    "event_id": "string",
    "timestamp": "string",
    "product_id": "string",
    "product_name": "string",
    "quantity": "bigint",
    "unit_price": "double",
    "total_amount": "double",
    "region": "string",
    "channel": "string",
}
SALE_EVENT = ", ".join(f"{name} {kind}" for name, kind in SALE_FIELDS.items())

SALES_ENVELOPE = f"""
    batch_date string, batch_timestamp string, total_events bigint,
    events array<struct<{SALE_EVENT}>>
"""

REACH_BREAKDOWN = """
    array<struct<country string, age_gender_breakdowns array<struct<
        age_range string, female bigint, male bigint, unknown bigint>>>>
"""

AD = f"""
    id string, eu_total_reach bigint, ad_delivery_start_time string,
    target_gender string, target_ages array<string>,
    publisher_platforms array<string>,
    age_country_gender_reach_breakdown {REACH_BREAKDOWN}
"""

SNAPSHOT_ENVELOPE = f"""
    extraction_date string, extraction_timestamp string, total_ads bigint,
    ads array<struct<{AD}>>
"""

# one response page of the ads API, as dumped to storage
ADS_PAGE = f"""
    data array<struct<{AD}>>,
    paging struct<cursors struct<after string>>
"""

CATALOGUE = """
    products array<struct<id string, name string, category string, price double>>
"""

# ---- keys of the relational tables --------------------------------------
KEYS = {
    SQL_PRODUCTS: ["product_id"],
    SQL_MAPPING: ["ad_id"],
    SQL_SPEND: ["ad_id", "date"],
}
