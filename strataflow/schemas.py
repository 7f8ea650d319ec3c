"""Schemas of the layers. Names and column orders are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# --- ODS -------------------------------------------------------------------------------------
# Leaves of the raw log are read as text and cast afterwards, so a number given as text does not
# make a whole record unreadable.

LOG_COMMON = _texts("mid", "uid", "is_new", "vc", "ch", "ar")
LOG_PAGE = _texts("page_id", "last_page_id", "during_time", "item", "item_type")
LOG_DISPLAY = _texts("display_type", "item", "item_type", "order", "pos_id")
LOG_ACTION = _texts("action_id", "item", "item_type", "ts")
LOG_START = _texts("entry", "loading_time", "open_ad_id")
LOG_ERR = _texts("error_code", "msg")

LOG_TEXT = T.StructType(
    [
        T.StructField("common", LOG_COMMON),
        T.StructField("page", LOG_PAGE),
        T.StructField("displays", T.ArrayType(LOG_DISPLAY)),
        T.StructField("actions", T.ArrayType(LOG_ACTION)),
        T.StructField("start", LOG_START),
        T.StructField("err", LOG_ERR),
        T.StructField("ts", T.StringType()),
    ]
)

CHANGE_ROW = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("old", T.MapType(T.StringType(), T.StringType())),
    ]
)

DICTIONARY = _texts("dic_code", "dic_name")

# --- DIM -------------------------------------------------------------------------------------

ROUTE_CONFIG = _texts("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

# The fifteen seed rows of the routing table: source table -> columns kept. Each one goes to the
# table named dim_<source table>, keyed by id.
DIMENSION_COLUMNS = {
    "activity_info": "id,activity_name,activity_type,activity_desc,start_time,end_time,create_time",
    "activity_rule": "id,activity_id,activity_type,condition_amount,condition_num,benefit_amount,"
    "benefit_discount,benefit_level",
    "activity_sku": "id,activity_id,sku_id,create_time",
    "base_category1": "id,name",
    "base_category2": "id,name,category1_id",
    "base_category3": "id,name,category2_id",
    "base_province": "id,name,region_id,area_code,iso_code,iso_3166_2",
    "base_region": "id,region_name",
    "base_trademark": "id,tm_name",
    "coupon_info": "id,coupon_name,coupon_type,condition_amount,condition_num,activity_id,benefit_amount,"
    "benefit_discount,create_time,range_type,limit_num,taken_count,start_time,end_time,operate_time,"
    "expire_time,range_desc",
    "coupon_range": "id,coupon_id,range_type,range_id",
    "financial_sku_cost": "id,sku_id,sku_name,busi_date,is_lastest,sku_cost,create_time",
    "sku_info": "id,spu_id,price,sku_name,sku_desc,weight,tm_id,category3_id,sku_default_img,is_sale,create_time",
    "spu_info": "id,spu_name,description,category3_id,tm_id",
    "user_info": "id,login_name,name,user_level,birthday,gender,create_time,operate_time",
}


def dimension_schema(sink_columns: str) -> T.StructType:
    """All columns of a dimension table are text."""
    return _texts(*sink_columns.split(","))


# --- DWD -------------------------------------------------------------------------------------

DWD_COLUMNS = {
    "dwd_trade_cart_add": "id user_id sku_id sku_num source_type source_type_name ts",
    "dwd_trade_order_pre_process": "id order_id user_id order_status sku_id sku_name province_id activity_id "
    "activity_rule_id coupon_id date_id create_time operate_date_id operate_time source_id source_type "
    "source_type_name sku_num split_original_amount split_activity_amount split_coupon_amount "
    "split_total_amount type old od_ts oi_ts row_op_ts",
    "dwd_trade_order_detail": "id order_id user_id sku_id sku_name province_id activity_id activity_rule_id "
    "coupon_id date_id create_time source_id source_type_code source_type_name sku_num split_original_amount "
    "split_activity_amount split_coupon_amount split_total_amount ts row_op_ts",
    "dwd_trade_cancel_detail": "id order_id user_id sku_id sku_name province_id activity_id activity_rule_id "
    "coupon_id date_id cancel_time source_id source_type_code source_type_name sku_num split_original_amount "
    "split_activity_amount split_coupon_amount split_total_amount ts row_op_ts",
    "dwd_trade_pay_detail_suc": "order_detail_id order_id user_id sku_id sku_name province_id activity_id "
    "activity_rule_id coupon_id payment_type_code payment_type_name callback_time source_id source_type_code "
    "source_type_name sku_num split_original_amount split_activity_amount split_coupon_amount "
    "split_payment_amount ts row_op_ts",
    "dwd_trade_order_refund": "id user_id order_id sku_id province_id date_id create_time refund_type_code "
    "refund_type_name refund_reason_type_code refund_reason_type_name refund_reason_txt refund_num "
    "refund_amount ts row_op_ts",
    "dwd_trade_refund_pay_suc": "id user_id order_id sku_id province_id payment_type_code payment_type_name "
    "date_id callback_time refund_num refund_amount ts row_op_ts",
    "dwd_tool_coupon_get": "id coupon_id user_id date_id get_time ts",
    "dwd_tool_coupon_order": "id coupon_id user_id date_id using_time ts",
    "dwd_tool_coupon_pay": "id coupon_id user_id date_id used_time ts",
    "dwd_interaction_favor_add": "id user_id sku_id date_id create_time ts",
    "dwd_interaction_comment": "id user_id sku_id order_id date_id create_time appraise_code appraise_name ts",
    "dwd_user_register": "user_id date_id create_time ts",
}

# --- DWS -------------------------------------------------------------------------------------
# Columns between stt, edt and the processing time ts, which is added at the sink.

DWS_COLUMNS = {
    "dws_traffic_source_keyword_page_view_window": "source keyword keyword_count",
    "dws_traffic_vc_ch_ar_is_new_page_view_window": "vc ch ar is_new uv_ct sv_ct pv_ct dur_sum uj_ct",
    "dws_traffic_page_view_window": "home_uv_ct good_detail_uv_ct",
    "dws_user_user_login_window": "back_ct uu_ct",
    "dws_user_user_register_window": "register_ct",
    "dws_trade_cart_add_uu_window": "cart_add_uu_ct",
    "dws_trade_payment_suc_window": "payment_suc_unique_user_count payment_new_user_count",
    "dws_trade_order_window": "order_unique_user_count order_new_user_count",
    "dws_trade_sku_order_window": "trademark_id trademark_name category1_id category1_name category2_id "
    "category2_name category3_id category3_name sku_id sku_name spu_id spu_name order_count original_amount "
    "activity_amount coupon_amount order_amount",
    "dws_trade_province_order_window": "province_id province_name order_count order_amount",
    "dws_trade_trademark_category_user_refund_window": "trademark_id trademark_name category1_id category1_name "
    "category2_id category2_name category3_id category3_name user_id refund_count",
}


def columns_of(table: str) -> list[str]:
    """Result columns of a DWD or DWS table, in order (DWS without the processing time)."""
    if table in DWD_COLUMNS:
        return DWD_COLUMNS[table].split()
    return ["stt", "edt", *DWS_COLUMNS[table].split()]


def detail_schema(table: str) -> T.StructType:
    """Schema of a DWD table: text, but for the few typed columns."""
    typed = {"old": T.MapType(T.StringType(), T.StringType()), "row_op_ts": T.TimestampType()}
    if table == "dwd_trade_cart_add":
        typed["ts"] = T.LongType()
    return T.StructType([T.StructField(name, typed.get(name, T.StringType())) for name in columns_of(table)])


PAGE_ROW = T.StructType(
    [T.StructField("common", LOG_COMMON), T.StructField("page", LOG_PAGE), T.StructField("ts", T.LongType())]
)
