"""Declared tables of the warehouse layers and the keys the checks enforce."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyfield.operators.quality import declared_keys, duplicate_rows, report
from tallyfield.sources.warehouse import Warehouse

# Column names and types of the source tables and the derived tables.
TABLES = {
    "raw": {
        "customers": """customer_id string, first_name string, last_name string, email string, phone string, date_of_birth date,
            gender string, registration_date timestamp, address_line1 string, address_line2 string, city string, state string,
            postal_code string, country string, preferred_language string, marketing_consent boolean""",
        "products": """product_id string, product_name string, category string, subcategory string, brand string, description string,
            unit_price decimal(10,2), cost_price decimal(10,2), weight decimal(8,2), dimensions string, color string, size string,
            stock_quantity int, is_active boolean""",
        "orders": """order_id string, customer_id string, order_date timestamp, order_status string, total_amount decimal(12,2),
            tax_amount decimal(10,2), shipping_amount decimal(10,2), discount_amount decimal(10,2), payment_method string,
            delivery_date timestamp""",
        "order_items": """order_item_id string, order_id string, product_id string, quantity int, unit_price decimal(10,2),
            total_price decimal(12,2), discount_amount decimal(10,2)""",
        "website_sessions": """session_id string, customer_id string, session_start timestamp, session_end timestamp, device_type string,
            browser string, operating_system string, traffic_source string, utm_source string, utm_medium string, utm_campaign string,
            pages_viewed int, bounce_rate decimal(5,2), conversion_flag boolean""",
        "page_views": """page_view_id string, session_id string, page_url string, page_title string, timestamp timestamp,
            time_on_page int, exit_page boolean""",
        "marketing_campaigns": """campaign_id string, campaign_name string, campaign_type string, start_date date, end_date date,
            budget decimal(12,2), target_audience string, channel string, status string""",
        "support_tickets": """ticket_id string, customer_id string, order_id string, issue_type string, priority string, status string,
            created_date timestamp, resolved_date timestamp, satisfaction_score int""",
        "product_reviews": """review_id string, product_id string, customer_id string, order_id string, rating int, review_text string,
            helpful_votes int, verified_purchase boolean, review_date timestamp""",
    },
    "analytics": {
        "fact_customer_metrics": """customer_id string, metric_date date, total_orders int, total_revenue decimal(12,2),
            avg_order_value decimal(10,2), days_since_last_order int, lifetime_value decimal(12,2), recency_score int,
            frequency_score int, monetary_score int, rfm_segment string, churn_probability decimal(5,4)""",
        "fact_product_performance": """product_id string, metric_date date, units_sold int, revenue decimal(12,2), avg_rating decimal(3,2),
            review_count int, return_rate decimal(5,4), stock_turnover decimal(8,2)""",
        "fact_campaign_performance": """campaign_id string, metric_date date, impressions int, clicks int, conversions int,
            cost decimal(10,2), revenue decimal(12,2), ctr decimal(5,4), conversion_rate decimal(5,4), roas decimal(8,2), cpa decimal(10,2)""",
    },
    "mart": {
        "dm_executive_kpis": """report_date date, total_revenue decimal(15,2), total_orders int, new_customers int, returning_customers int,
            avg_order_value decimal(10,2), customer_acquisition_cost decimal(10,2), customer_lifetime_value decimal(12,2),
            churn_rate decimal(5,4), monthly_active_users int, conversion_rate decimal(5,4)""",
        "dm_customer_cohorts": """cohort_month date, period_number int, customers_count int, retention_rate decimal(5,4),
            avg_revenue_per_user decimal(10,2), cumulative_revenue decimal(15,2)""",
        "dm_category_performance": """category string, subcategory string, report_date date, revenue decimal(12,2), units_sold int,
            avg_price decimal(10,2), profit_margin decimal(5,4), market_share decimal(5,4), growth_rate decimal(5,4)""",
    },
}

# Unique keys and references of the source tables.
UNIQUE_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "website_sessions": "session_id",
    "page_views": "page_view_id",
    "marketing_campaigns": "campaign_id",
    "support_tickets": "ticket_id",
    "product_reviews": "review_id",
}
REFERENCES = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("website_sessions", "customer_id", "customers", "customer_id"),
    ("page_views", "session_id", "website_sessions", "session_id"),
    ("support_tickets", "customer_id", "customers", "customer_id"),
    ("support_tickets", "order_id", "orders", "order_id"),
    ("product_reviews", "product_id", "products", "product_id"),
    ("product_reviews", "customer_id", "customers", "customer_id"),
    ("product_reviews", "order_id", "orders", "order_id"),
]


def schema(layer: str, table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[layer][table])


def declare(warehouse: Warehouse) -> None:
    """Create the empty tables that do not exist yet."""
    for layer, tables in TABLES.items():
        for table in tables:
            warehouse.create(layer, table, schema(layer, table))


def key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Unique-key and reference checks for the tables given; Spark enforces neither."""
    keys = [duplicate_rows(df, [UNIQUE_KEYS[n]], f"{n}.{UNIQUE_KEYS[n]} unique") for n, df in tables.items()]
    known = [r for r in REFERENCES if r[0] in tables and r[2] in tables]
    out = report(keys)
    return out.unionByName(declared_keys(tables, known)) if known else out
