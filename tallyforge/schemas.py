"""Record layouts used by the sources, the jobs and the tests."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP, AMOUNT = T.TimestampType(), T.DecimalType(15, 2)

REVIEWS = _struct(id=STRING, comment=STRING, aspect=STRING, category=STRING, sentiment=STRING)

RATINGS = _struct(user_id=STRING, item_id=STRING, rating=DOUBLE, epoch=LONG)
ITEMS = _struct(item_id=STRING, title=STRING, labels=STRING)
USERS = _struct(user_id=STRING, gender=STRING, age=INT, occupation_id=STRING, zip=STRING)
OCCUPATIONS = _struct(occupation_id=STRING, occupation=STRING)

# Header names of the sales files -> (column name here, type)
ORDERS_CSV = {
    "Order_ID": ("order_id", STRING),
    "Customer_Trx_ID": ("customer_id", STRING),
    "Order_Purchase_Timestamp": ("purchased_at", TIMESTAMP),
    "Order_Delivered_Carrier_Date": ("handed_over_at", TIMESTAMP),
}
CUSTOMERS_CSV = {
    "Customer_Trx_ID": ("customer_id", STRING),
    "Customer_Country": ("country", STRING),
}
ORDER_ITEMS_CSV = {
    "Order_ID": ("order_id", STRING),
    "Product_ID": ("product_id", STRING),
    "Seller_ID": ("seller_id", STRING),
    "Price": ("price", AMOUNT),
    "Freight_Value": ("freight", AMOUNT),
    "Shipping_Limit_Date": ("ship_by", TIMESTAMP),
}
PRODUCTS_CSV = {
    "Product_ID": ("product_id", STRING),
    "Product_Category_Name": ("category", STRING),
}
ORDER_REVIEWS_CSV = {
    "Order_ID": ("order_id", STRING),
    "Review_Score": ("review_score", STRING),
}

# Field names of the messages
FRAME = _struct(
    frame_id=STRING, timestamp=DOUBLE, camera_id=STRING, width=INT, height=INT, frame_b64=STRING
)

BOX = _struct(x1=INT, y1=INT, x2=INT, y2=INT, confidence=DOUBLE, label=STRING)

# What a detector hook returns per object, before filtering and rounding
RAW_BOX = _struct(
    x1=DOUBLE, y1=DOUBLE, x2=DOUBLE, y2=DOUBLE, confidence=DOUBLE, class_id=INT
)

DETECTION = _struct(
    frame_id=STRING,
    timestamp=DOUBLE,
    camera_id=STRING,
    processed_at=DOUBLE,
    inference_time=DOUBLE,
    person_count=INT,
    bounding_boxes=T.ArrayType(BOX),
)

DETECTION_EVENTS = _struct(
    frame_id=STRING,
    camera_id=STRING,
    captured_at=TIMESTAMP,
    processed_at=TIMESTAMP,
    person_count=INT,
    inference_time=DOUBLE,
    created_at=TIMESTAMP,
)

# As stored: beside the event its day, which is a folder of the table
STORED_EVENTS = T.StructType([*DETECTION_EVENTS, T.StructField("event_date", T.DateType())])

BOUNDING_BOXES = _struct(frame_id=STRING, x1=INT, y1=INT, x2=INT, y2=INT, confidence=DOUBLE)

# Statistics as stored, with the day of the minute as folder
STORED_MINUTES = _struct(
    minute=TIMESTAMP,
    camera_id=STRING,
    avg_persons=DOUBLE,
    max_persons=INT,
    frame_count=LONG,
    day=T.DateType(),
)
