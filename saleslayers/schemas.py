"""Column layouts of every table.

Fixed values: names and types below are the data contract of the raw files and the
refined and report tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TIMESTAMP, DATE, BOOLEAN, BINARY = T.TimestampType(), T.DateType(), T.BooleanType(), T.BinaryType()


def DECIMAL(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, type_) for name, type_ in columns.items()])


# --- raw files (CSV, every column nullable) ------------------------------------------

SALE_ORDERS = _table(
    salesordernumber=STRING,
    salesorderlinenumber=INT,
    createddate=TIMESTAMP,
    processeddate=TIMESTAMP,
    ordertype=STRING,
    quantity=INT,
    unitprice=DOUBLE,
    taxamount=DOUBLE,
    customer_id=STRING,
    product_id=STRING,
    supplier_id=STRING,
    warehouse_id=STRING,
)
CUSTOMERS = _table(
    FirstName=STRING,
    LastName=STRING,
    CompanyName=STRING,
    EmailAddress=STRING,
    Phone=STRING,
    CustomerID=STRING,
    AddressLine1=STRING,
    City=STRING,
    CountryRegion=STRING,
    PostalCode=STRING,
)
PRODUCTS = _table(
    ProductID=INT,
    Name=STRING,
    ProductNumber=STRING,
    Color=STRING,
    StandardCost=DECIMAL(10, 2),
    ListPrice=DECIMAL(10, 2),
    Size=STRING,
    Weight=DECIMAL(10, 2),
    ProductCategoryID=INT,
    ProductModelID=INT,
    SellStartDate=TIMESTAMP,
    ThumbNailPhoto=STRING,
    ThumbnailPhotoFileName=STRING,
    rowguid=STRING,
)
SUPPLIERS = _table(
    supplier_id=STRING,
    supplier_name=STRING,
    contact_name=STRING,
    email=STRING,
    phone=STRING,
    address=STRING,
    city=STRING,
    state=STRING,
    country=STRING,
    postal_code=STRING,
    business_category=STRING,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)
WAREHOUSES = _table(
    warehouse_id=STRING,
    warehouse_name=STRING,
    location=STRING,
    city=STRING,
    state=STRING,
    country=STRING,
    postal_code=STRING,
    capacity=STRING,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)

# --- refined tables ------------------------------------------------------------------

VALIDITY = {
    "start_date": TIMESTAMP,
    "end_date": TIMESTAMP,
    "is_current": BOOLEAN,
    "created_at": TIMESTAMP,
    "updated_at": TIMESTAMP,
}

DIM_CUSTOMERS = _table(
    customer_id=INT,
    customer_name=STRING,
    email=STRING,
    phone=STRING,
    region=STRING,
    postal_code=STRING,
    country=STRING,
    company_name=STRING,
    address_line=STRING,
    **VALIDITY,
)
DIM_PRODUCTS = _table(
    product_id=INT,
    product_name=STRING,
    product_number=INT,
    category=INT,
    sub_category=INT,
    color=STRING,
    size=STRING,
    weight=DOUBLE,
    unit_price=DOUBLE,
    cost_price=DOUBLE,
    sell_start_date=TIMESTAMP,
    thumbnail_photo=BINARY,
    thumbnail_photo_file_name=STRING,
    rowguid=STRING,
    **VALIDITY,
)
DIM_SUPPLIERS = _table(
    supplier_id=STRING,
    supplier_name=STRING,
    contact_name=STRING,
    email=STRING,
    phone=STRING,
    address=STRING,
    city=STRING,
    state=STRING,
    country=STRING,
    postal_code=STRING,
    business_category=STRING,
    **VALIDITY,
)
DIM_WAREHOUSES = _table(
    warehouse_id=STRING,
    warehouse_name=STRING,
    location=STRING,
    city=STRING,
    state=STRING,
    country=STRING,
    postal_code=INT,
    capacity=INT,
    **VALIDITY,
)
FACT_SALE_ORDERS = _table(
    salesordernumber=STRING,
    salesorderlinenumber=INT,
    ordertype=STRING,
    quantity=INT,
    taxamount=DECIMAL(7, 4),
    unitprice=DECIMAL(8, 4),
    customer_id=INT,
    product_id=INT,
    createddate=TIMESTAMP,
    processeddate=TIMESTAMP,
    supplier_id=STRING,
    warehouse_id=STRING,
    year=INT,
    month=INT,
    day=INT,
)

# --- report tables -------------------------------------------------------------------
# total_orders is BIGINT: an order count per group can pass the INT range at scale.

SALES_SUMMARY = _table(
    customer_name=STRING,
    product_name=STRING,
    supplier_name=STRING,
    warehouse_name=STRING,
    sale_date=DATE,
    total_quantity_sold=DOUBLE,
    total_sales_amount=DOUBLE,
    total_tax_collected=DOUBLE,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)
BY_COUNTRY = _table(
    country=STRING,
    total_sales_amount=DOUBLE,
    total_quantity_sold=DOUBLE,
    total_orders=BIGINT,
    last_updated=TIMESTAMP,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)
BY_SUPPLIER_DAILY = _table(
    sales_date=DATE,
    supplier_id=STRING,
    supplier_name=STRING,
    total_sales_amount=DOUBLE,
    total_quantity_sold=DOUBLE,
    total_orders=BIGINT,
    last_updated=TIMESTAMP,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)
BY_SUPPLIER_MONTHLY = _table(
    sales_month=STRING,
    supplier_id=STRING,
    supplier_name=STRING,
    total_sales_amount=DOUBLE,
    total_quantity_sold=DOUBLE,
    total_orders=BIGINT,
    last_updated=TIMESTAMP,
    created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)

# --- bookkeeping tables --------------------------------------------------------------

FILE_REGISTRY = _table(
    file_key=STRING,
    source_zip=STRING,
    upload_timestamp=TIMESTAMP,
    status=STRING,
    processed_at=TIMESTAMP,
    entry=STRING,
    reason=STRING,
)
LANDING_PLANS = _table(
    key=STRING,
    source_zip=STRING,
    entry=STRING,
    target=STRING,
    status=STRING,
    planned_at=TIMESTAMP,
)
LOAD_LEDGER = _table(
    ingest_batch=BIGINT,
    ingestion_timestamp=TIMESTAMP,
    read_rows=BIGINT,
    malformed_rows=BIGINT,
    kept_rows=BIGINT,
)
FACT_LEDGER = _table(
    ingest_batch=BIGINT,
    valid_lines=BIGINT,
    rejected_lines=BIGINT,
)
MIGRATION_LEDGER = _table(
    filename=STRING,
    applied_at=TIMESTAMP,
)
