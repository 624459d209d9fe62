"""Column types, declared once; nothing is inferred."""

from pyspark.sql import types as T

# Amounts of a single row. Eighteen digits stay in a machine word inside Spark and Parquet.
MONEY = T.DecimalType(18, 4)
# Sums of them, as text for schemas of single rows.
MONEY_SUM = "decimal(28,4)"
# What is written, before it is checked to fit; further digits than these cannot be told apart.
AS_WRITTEN = T.DecimalType(38, 18)
# Operands of a ratio of sums; leaves Spark fourteen digits after the point in the quotient.
RATIO_OPERAND = T.DecimalType(24, 4)

ORDER_DOCUMENT = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("total_amount", AS_WRITTEN),
        # A string field keeps the nested array as its JSON text.
        T.StructField("items", T.StringType()),
        # An order too large for one document comes in several, cut along the order of its lines: number of the
        # part, how many lines the earlier parts hold, and the product of the last of those.
        T.StructField("part", T.IntegerType()),
        T.StructField("lines_before", T.LongType()),
        T.StructField("product_before", T.StringType()),
    ]
)

# Items with numbers parsed right away, with more digits than are kept, so that an amount or a quantity that
# does not fit can be told from one that does; a text where a number belongs is accepted when it spells one.
ITEMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("qty", AS_WRITTEN),
            T.StructField("unit_price", AS_WRITTEN),
            T.StructField("discount", AS_WRITTEN),
            T.StructField("subtotal", AS_WRITTEN),
        ]
    )
)

# Items with all fields as they are written, for checks that look at malformed ones.
ITEM_TEXT = T.ArrayType(
    T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("qty", T.StringType()),
            T.StructField("unit_price", T.StringType()),
            T.StructField("discount", T.StringType()),
            T.StructField("subtotal", T.StringType()),
        ]
    )
)
