"""The eight-column invoice-line contract shared by all jobs."""

from __future__ import annotations

# Contract column, Spark type.
CONTRACT: dict[str, str] = {
    "invoice_no": "string",
    "stock_code": "string",
    "description": "string",
    "quantity": "decimal(16,4)",
    "invoice_date": "timestamp_ntz",
    "unit_price": "decimal(18,6)",
    "customer_id": "bigint",
    "country": "string",
}

# Header spellings found in retail files, without case, blanks and punctuation.
HEADER_SPELLINGS: dict[str, str] = {
    "invoice": "invoice_no",
    "invoiceno": "invoice_no",
    "stockcode": "stock_code",
    "description": "description",
    "quantity": "quantity",
    "invoicedate": "invoice_date",
    "price": "unit_price",
    "unitprice": "unit_price",
    "customerid": "customer_id",
    "country": "country",
}

# Texts standing in for missing ones.
UNKNOWN_PRODUCT = "Unknown product"
UNKNOWN_COUNTRY = "Unknown country"
UNKNOWN_CUSTOMER_PREFIX = "UNKNOWN_"

# Where a line came from. ``source_rank`` orders the sources, 1 being the first.
LINEAGE: tuple[str, ...] = ("source_rank", "source_system", "source_sheet", "source_name")

COLUMNS: tuple[str, ...] = tuple(CONTRACT)
