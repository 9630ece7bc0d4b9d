"""What is known about the columns of the nine source tables.

A table is a list of column records. Reading (types, line breaks), cleaning (keys, types) and
checking (references, ranges, accepted values) all look columns up by what their record says.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    """One column: its type once cleaned, and what its values promise."""

    name: str
    type: str = "string"  # string, timestamp, double or int
    in_key: bool = False
    refers_to: str | None = None  # "table.column"; that table comes earlier in the catalog
    required: bool = False
    low: int | None = None
    high: int | None = None
    values: tuple[object, ...] | None = None
    line_breaks: bool = False  # raw cells may hold them


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]

    def __iter__(self) -> Iterator[Field]:
        return iter(self.fields)

    def named(self, **traits: object) -> list[str]:
        """Names of the columns whose record has these values, in order."""
        return [f.name for f in self if all(getattr(f, k) == v for k, v in traits.items())]

    @property
    def multi_line(self) -> bool:
        """Whether a raw file must be read whole by one task."""
        return any(f.line_breaks for f in self)


def table(name: str, *fields: Field | str) -> Table:
    """A table of column records; a plain name is a text column."""
    return Table(name, tuple(Field(f) if isinstance(f, str) else f for f in fields))


# Names, keys and domains of the data model.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
MONEY_COLUMNS = ("price", "freight_value", "payment_value")


def _id(name: str, refers_to: str | None = None) -> Field:
    return Field(name, in_key=True, required=True, refers_to=refers_to)


def _link(name: str, refers_to: str) -> Field:
    return Field(name, required=True, refers_to=refers_to)


def _time(name: str) -> Field:
    return Field(name, "timestamp")


def _number(name: str, low: int | None = None, high: int | None = None) -> Field:
    return Field(name, "double", low=low, high=high)


# Tables come before those that refer to them.
CATALOG: dict[str, Table] = {
    t.name: t
    for t in (
        table(
            "customers",
            _id("customer_id"),
            Field("customer_unique_id", required=True),
            Field("customer_zip_code_prefix", "int"),
            "customer_city",
            "customer_state",
        ),
        table(
            "sellers",
            _id("seller_id"),
            Field("seller_zip_code_prefix", "int"),
            "seller_city",
            "seller_state",
        ),
        table(
            "products",
            _id("product_id"),
            "product_category_name",
            _number("product_name_lenght"),
            _number("product_description_lenght"),
            _number("product_photos_qty"),
            _number("product_weight_g"),
            _number("product_length_cm"),
            _number("product_height_cm"),
            _number("product_width_cm"),
        ),
        table(
            "product_category_translation",
            _id("product_category_name"),
            "product_category_name_english",
        ),
        table(
            "geolocation",
            Field("geolocation_zip_code_prefix", "int", required=True),
            _number("geolocation_lat"),
            _number("geolocation_lng"),
            "geolocation_city",
            "geolocation_state",
        ),
        table(
            "orders",
            _id("order_id"),
            _link("customer_id", "customers.customer_id"),
            Field("order_status", required=True, values=ORDER_STATUSES),
            _time("order_purchase_timestamp"),
            _time("order_approved_at"),
            _time("order_delivered_carrier_date"),
            _time("order_delivered_customer_date"),
            _time("order_estimated_delivery_date"),
        ),
        table(
            "order_items",
            _id("order_id", "orders.order_id"),
            Field("order_item_id", "int", in_key=True),
            _link("product_id", "products.product_id"),
            _link("seller_id", "sellers.seller_id"),
            _time("shipping_limit_date"),
            _number("price", low=0),
            _number("freight_value", low=0),
        ),
        table(
            "order_payments",
            _id("order_id", "orders.order_id"),
            Field("payment_sequential", "int", in_key=True),
            Field("payment_type", required=True),
            _number("payment_installments"),
            _number("payment_value", low=0),
        ),
        table(
            "order_reviews",
            _id("review_id"),
            _link("order_id", "orders.order_id"),
            _number("review_score", low=1, high=5),
            Field("review_comment_title", line_breaks=True),
            Field("review_comment_message", line_breaks=True),
            _time("review_creation_date"),
            _time("review_answer_timestamp"),
        ),
    )
}


def spec_of(name: str) -> Table:
    if name not in CATALOG:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(CATALOG)}")
    return CATALOG[name]
