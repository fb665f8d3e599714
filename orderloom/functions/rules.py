"""Business rules, kept as data, and the predicates built from them."""

from __future__ import annotations

from orderloom.functions import quoted

# The event that carries a fetched order.
ACTION = "interior_fetch_order_detail_pubsub_success"
URL = "order-fetched"

# The order statuses that count as first, per channel. Case matters.
FIRST_STATUSES = {
    "blib": ["PU", "FP"],
    "lzda": ["unpaid", "pending", "packed"],
    "shpe": ["PROCESSED", "READY_TO_SHIP", "UNPAID"],
    "tkpd": ["220"],
    "tktk": ["accepted", "packed", "unpaid"],
    "zlra": ["pending"],
}

# Channel codes with one of these words are not shops.
EXCLUDED_CHANNEL_WORDS = ["request", "interco", "csr", "nonevent", "reclass", "non event", "offline"]

# Channel names of this kind carry no store name after a dash.
B2B_NAMES = ["B2B Beauty", "B2B JNS", "B2BJNS"]

# Stores sold under another name, by lower-case prefix.
STORE_RENAMES = {
    "sleek": "Kino Baby & Kids Official Store",
    "ellip": "Kino Hair & Beauty Care Official Store",
}

# Fixed value: characters taken out of a store name.
STORE_NAME_JUNK = "[^-0-9A-Za-z&() ]"


def first_status(channel: str, status: str) -> str:
    """True when the status is one of the channel's first statuses."""
    pairs = [f"({quoted(c)}, {quoted(s)})" for c, statuses in FIRST_STATUSES.items() for s in statuses]
    return f"({channel}, {status}) in ({', '.join(pairs)})"


def wanted_event(action: str, url: str, channel: str, status: str) -> str:
    return (
        f"{action} = {quoted(ACTION)} and {url} = {quoted(URL)} and {first_status(channel, status)}"
    )
