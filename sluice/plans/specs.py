"""Declarative table specs for the multi-table load.

Fixed values: the eleven TPC-DS target tables as loaded by the reference
workload -- column names and types in table order, and one or two partition
columns per table (income_band unpartitioned). Money columns are DOUBLE there
(the TPC-DS spec says DECIMAL(7,2)); they are kept as DOUBLE so loaded values
compare one to one. web_returns uses the 24 ``wr_*`` columns of the published
schema.
"""

from __future__ import annotations

from sluice.sinks.tables import TableSpec


def _cols(ddl: str) -> tuple[tuple[str, str], ...]:
    """``"a int, b decimal(15,2), c map<string,int>"`` -> ((name, type), ...);
    commas inside parentheses or angle brackets belong to the type."""
    parts, depth, cur = [], 0, ""
    for ch in ddl:
        depth += ch in "(<"
        depth -= ch in ")>"
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    parts.append(cur)
    out = []
    for part in parts:
        name, typ = part.strip().split(None, 1)
        out.append((name, typ.replace(" ", "")))
    return tuple(out)


# Fixed values (column lists, in order).
_TPCDS = {
    "customer": (
        "c_customer_sk int, c_customer_id string, c_current_cdemo_sk int, c_current_hdemo_sk int, "
        "c_current_addr_sk int, c_first_shipto_date_sk int, c_first_sales_date_sk int, "
        "c_salutation string, c_first_name string, c_last_name string, c_preferred_cust_flag string, "
        "c_birth_day int, c_birth_month int, c_birth_year int, c_birth_country string, c_login string, "
        "c_email_address string, c_last_review_date string",
        ("c_birth_country",),
    ),
    "web_sales": (
        "ws_sold_date_sk int, ws_sold_time_sk int, ws_ship_date_sk int, ws_item_sk int, "
        "ws_bill_customer_sk int, ws_bill_cdemo_sk int, ws_bill_hdemo_sk int, ws_bill_addr_sk int, "
        "ws_ship_customer_sk int, ws_ship_cdemo_sk int, ws_ship_hdemo_sk int, ws_ship_addr_sk int, "
        "ws_web_page_sk int, ws_web_site_sk int, ws_ship_mode_sk int, ws_warehouse_sk int, "
        "ws_promo_sk int, ws_order_number int, ws_quantity int, ws_wholesale_cost double, "
        "ws_list_price double, ws_sales_price double, ws_ext_discount_amt double, "
        "ws_ext_sales_price double, ws_ext_wholesale_cost double, ws_ext_list_price double, "
        "ws_ext_tax double, ws_coupon_amt double, ws_ext_ship_cost double, ws_net_paid double, "
        "ws_net_paid_inc_tax double, ws_net_paid_inc_ship double, ws_net_paid_inc_ship_tax double, "
        "ws_net_profit double",
        ("ws_warehouse_sk",),
    ),
    "customer_address": (
        "ca_address_sk int, ca_address_id string, ca_street_number string, ca_street_name string, "
        "ca_street_type string, ca_suite_number string, ca_city string, ca_county string, "
        "ca_state string, ca_zip string, ca_country string, ca_gmt_offset float, "
        "ca_location_type string",
        ("ca_country", "ca_city"),
    ),
    "date_dim": (
        "d_date_sk int, d_date_id string, d_date date, d_month_seq int, d_week_seq int, "
        "d_quarter_seq int, d_year int, d_dow int, d_moy int, d_dom int, d_qoy int, d_fy_year int, "
        "d_fy_quarter_seq int, d_fy_week_seq int, d_day_name string, d_quarter_name string, "
        "d_holiday string, d_weekend string, d_following_holiday string, d_first_dom int, "
        "d_last_dom int, d_same_day_ly int, d_same_day_lq int, d_current_day string, "
        "d_current_week string, d_current_month string, d_current_quarter string, "
        "d_current_year string",
        ("d_year",),
    ),
    "household_demographics": (
        "hd_demo_sk int, hd_income_band_sk int, hd_buy_potential string, hd_dep_count int, "
        "hd_vehicle_count int",
        ("hd_buy_potential",),
    ),
    "income_band": ("ib_income_band_sk int, ib_lower_bound int, ib_upper_bound int", ()),
    "item": (
        "i_item_sk int, i_item_id string, i_rec_start_date string, i_rec_end_date string, "
        "i_item_desc string, i_current_price double, i_wholesale_cost double, i_brand_id int, "
        "i_brand string, i_class_id int, i_class string, i_category_id int, i_category string, "
        "i_manufact_id int, i_manufact string, i_size string, i_formulation string, i_color string, "
        "i_units string, i_container string, i_manager_id string, i_product_name string",
        ("i_category",),
    ),
    "promotion": (
        "p_promo_sk int, p_promo_id string, p_start_date_sk int, p_end_date_sk int, p_item_sk int, "
        "p_cost double, p_response_target int, p_promo_name string, p_channel_dmail string, "
        "p_channel_email string, p_channel_catalog string, p_channel_tv string, "
        "p_channel_radio string, p_channel_press string, p_channel_event string, "
        "p_channel_demo string, p_channel_details string, p_purpose string, "
        "p_discount_active string",
        ("p_purpose",),
    ),
    "time_dim": (
        "t_time_sk int, t_time_id string, t_time int, t_hour int, t_minute int, t_second int, "
        "t_am_pm string, t_shift string, t_sub_shift string, t_meal_time string",
        ("t_hour",),
    ),
    "web_page": (
        "wp_web_page_sk int, wp_web_page_id string, wp_rec_start_date string, "
        "wp_rec_end_date string, wp_creation_date_sk int, wp_access_date_sk int, "
        "wp_autogen_flag string, wp_customer_sk int, wp_url string, wp_type string, "
        "wp_char_count int, wp_link_count int, wp_image_count int, wp_max_ad_count int",
        ("wp_rec_start_date",),
    ),
    "web_returns": (
        "wr_returned_date_sk int, wr_returned_time_sk int, wr_item_sk int, "
        "wr_refunded_customer_sk int, wr_refunded_cdemo_sk int, wr_refunded_hdemo_sk int, "
        "wr_refunded_addr_sk int, wr_returning_customer_sk int, wr_returning_cdemo_sk int, "
        "wr_returning_hdemo_sk int, wr_returning_addr_sk int, wr_web_page_sk int, wr_reason_sk int, "
        "wr_order_number int, wr_return_quantity int, wr_return_amt double, wr_return_tax double, "
        "wr_return_amt_inc_tax double, wr_fee double, wr_return_ship_cost double, "
        "wr_refunded_cash double, wr_reversed_charge double, wr_account_credit double, "
        "wr_net_loss double",
        ("wr_reason_sk",),
    ),
}

TPCDS_SPECS: tuple[TableSpec, ...] = tuple(
    TableSpec(name, _cols(ddl), parts, "parquet") for name, (ddl, parts) in _TPCDS.items()
)


def specs_from_json(text: str) -> list[TableSpec]:
    """Specs from JSON: ``[{"name": ..., "columns": "a int, b string",
    "partition_by": ["b"], "provider": "parquet", "options": {...},
    "source": ..., "defaults": {...}}, ...]`` (only name and columns are
    required)."""
    import json

    out = []
    for item in json.loads(text):
        out.append(
            TableSpec(
                item["name"],
                _cols(item["columns"]),
                tuple(item.get("partition_by", ())),
                item.get("provider", "parquet"),
                dict(item.get("options", {})),
                item.get("source"),
                dict(item.get("defaults", {})),
            )
        )
    return out


def spec(name: str) -> TableSpec:
    for s in TPCDS_SPECS:
        if s.name == name:
            return s
    raise KeyError(name)
