"""Domain settings: vocabularies, rates and size limits."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# They decide which records count as valid, so they are stated
# literally.
# ---------------------------------------------------------------------------

# Strings a delimited-text reader treats as missing before any other rule.
READER_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

INVALID_TOKENS = ("ERROR", "UNKNOWN", "N/A", "NA", "null", "none", "NaN", "")
INVALID_TOKENS_V1 = ("ERROR", "UNKNOWN", "N/A", "NA", "null", "none", "")
# Tokens the older validation looks for.
CHECKED_TOKENS_V1 = ("ERROR", "UNKNOWN", "N/A", "")

SHOP_ITEMS = ("Coffee", "Tea", "Cake", "Cookie", "Salad", "Sandwich",
              "Smoothie", "Juice", "Muffin", "Brownie", "Scone")
SHOP_PAYMENTS = ("Cash", "Credit Card", "Digital Wallet", "Debit Card")
SHOP_LOCATIONS = ("In-Store", "Takeaway", "Delivery")

SHOP_ITEMS_V1 = ("Coffee", "Tea", "Cake", "Cookie", "Salad", "Sandwich",
                 "Smoothie", "Juice")
SHOP_PAYMENTS_V1 = ("Cash", "Credit Card", "Digital Wallet")
SHOP_LOCATIONS_V1 = ("In-Store", "Takeaway")

SHOP_LOCATION_SPELLINGS = {"in store": "In-Store", "instore": "In-Store",
                           "take away": "Takeaway", "take-away": "Takeaway"}
SHOP_LOCATION_SPELLINGS_V1 = {"in store": "In-Store", "instore": "In-Store"}

COGS_RATE = "0.60"
TOTAL_TOLERANCE = "0.01"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Valid category values, alternative spellings and missing-value tokens.

    Values and aliases are matched without regard to case or surrounding
    blanks; the value as written here is what comes out.
    """

    items: tuple[str, ...]
    payments: tuple[str, ...]
    locations: tuple[str, ...]
    invalid_tokens: tuple[str, ...] = INVALID_TOKENS
    item_aliases: dict[str, str] = field(default_factory=dict)
    payment_aliases: dict[str, str] = field(default_factory=dict)
    location_aliases: dict[str, str] = field(default_factory=dict)

    def columns(self):
        """(column, valid values, aliases) for each categorical column."""
        return (
            ("item", self.items, self.item_aliases),
            ("payment_method", self.payments, self.payment_aliases),
            ("location", self.locations, self.location_aliases),
        )


SHOP = Vocabulary(
    items=SHOP_ITEMS,
    payments=SHOP_PAYMENTS,
    locations=SHOP_LOCATIONS,
    location_aliases=SHOP_LOCATION_SPELLINGS,
)

SHOP_V1 = Vocabulary(
    items=SHOP_ITEMS_V1,
    payments=SHOP_PAYMENTS_V1,
    locations=SHOP_LOCATIONS_V1,
    invalid_tokens=INVALID_TOKENS_V1,
    location_aliases=SHOP_LOCATION_SPELLINGS_V1,
)
