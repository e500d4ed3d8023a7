"""Rules for directory entries: organizations, products and their pricing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lodegate.functions.binding import filled, let
from lodegate.functions.markup import integer_field, kind, text_field

# JSON-LD types read as organizations and as products.
ORGANIZATION_TYPES = ("Organization", "Corporation", "LocalBusiness")
PRODUCT_TYPES = ("Product", "SoftwareApplication", "WebApplication")
PRICING_MODELS = ("FREE", "FREEMIUM", "PAID", "ENTERPRISE")
ADDRESS_FIELDS = ("streetAddress", "addressLocality", "addressRegion", "addressCountry")
MAKER_FIELDS = ("brand", "manufacturer", "author", "provider")


def address_text(node: Column, path: str = "$.address") -> Column:
    parts = [text_field(node, f"{path}.{field}") for field in ADDRESS_FIELDS]
    return F.coalesce(text_field(node, path), filled(F.concat_ws(", ", *parts)))


def founding_year(node: Column, path: str = "$.foundingDate") -> Column:
    """A year between 1800 and 2100, from a number or the start of a date text.

    Digits may follow the year as in a compact date (199004, 1990123, 19900401); a longer year is none.
    """
    pattern = r"^([0-9]{4})(?:(?![0-9])|[0-9]{2,3}$|[0-9]{4}(?![0-9]))"
    written = F.regexp_extract(F.try_variant_get(node, path, "string"), pattern, 1).try_cast("bigint")
    is_text = kind(F.try_variant_get(node, path, "variant")) == "STRING"
    return let(
        F.coalesce(integer_field(node, path), F.when(is_text, written)),
        lambda year: F.when(year.between(1800, 2100), year),
    )


def employee_count(node: Column, path: str = "$.numberOfEmployees") -> Column:
    counts = F.array(*[integer_field(node, p) for p in (path, f"{path}.value", f"{path}.minValue")])
    return F.get(F.filter(counts, lambda n: n >= 0), F.lit(0))


def is_organization(node: Column) -> Column:
    return F.coalesce(text_field(node, "$['@type']").isin(*ORGANIZATION_TYPES), F.lit(False))


def is_product(node: Column) -> Column:
    types = F.coalesce(
        F.try_variant_get(node, "$['@type']", "array<string>"), F.array(F.try_variant_get(node, "$['@type']", "string"))
    )
    return F.coalesce(F.arrays_overlap(types, F.array(*[F.lit(t) for t in PRODUCT_TYPES])), F.lit(False))


def maker_name(node: Column) -> Column:
    """First of brand, manufacturer, author, provider given as text or as an object with a name."""
    return F.coalesce(*[
        F.coalesce(text_field(node, f"$.{field}"), text_field(node, f"$.{field}.name")) for field in MAKER_FIELDS
    ])


def _offer_pricing(offer: Column) -> Column:
    """Pricing told by one offer, or null when it tells nothing."""
    words = F.upper(F.coalesce(text_field(offer, "$.description"), F.lit("")))
    price = F.try_variant_get(offer, "$.price", "variant")
    numeric = kind(price).isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    free_text = (kind(price) == "STRING") & text_field(offer, "$.price").isin("0", "0.0", "0.00")
    return (
        F.when(F.contains(words, F.lit("ENTERPRISE")), "ENTERPRISE")
        .when(F.contains(words, F.lit("FREEMIUM")), "FREEMIUM")
        .when(numeric & (F.try_variant_get(offer, "$.price", "double") == 0), "FREE")
        .when(numeric, "PAID")
        .when(free_text, "FREE")
    )


def linked_data_pricing(node: Column) -> Column:
    """Pricing model of a product node; null when the node gives no evidence."""
    explicit = F.replace(F.upper(text_field(node, "$.pricingModel")), F.lit("-"), F.lit("_"))
    accessible = F.try_variant_get(node, "$.isAccessibleForFree", "variant")
    is_free = (kind(accessible) == "BOOLEAN") & F.try_variant_get(accessible, "$", "boolean")
    listed = F.try_variant_get(node, "$.offers", "array<variant>")
    offers = F.coalesce(listed, F.array(F.try_variant_get(node, "$.offers", "variant")))
    told = F.transform(F.filter(offers, lambda o: kind(o) == "OBJECT"), _offer_pricing)
    return (
        F.when(explicit.isin(*PRICING_MODELS), explicit)
        .when(is_free, "FREE")
        .otherwise(F.get(F.filter(told, lambda p: p.isNotNull()), F.lit(0)))
    )


def card_pricing(folded: Column) -> Column:
    """Pricing model guessed from the case-folded text of a directory card."""
    has = lambda word: F.contains(folded, F.lit(word))
    return (
        F.when(has("free") & ~has("trial"), "FREE")
        .when(has("paid") | has("pricing"), "PAID")
        .when(has("enterprise") | has("contact"), "ENTERPRISE")
        .otherwise("FREEMIUM")
    )
