"""Golden inputs: pages, rates and people, as in FIXTURES.md."""

import json

# The four sales of a page (kind, store, yen or dollars, amount, time).
PAGE_SALES = [
    ("A001", 1, "yen", 15000, "2024-06-12T19:15:30.123Z"),
    ("A002", 1, "yen", 8000, "2024-06-12T19:45:30.456Z"),
    ("B001", 2, "us_doller", 20000, "2024-06-12T19:20:35.456Z"),
    ("B002", 2, "us_doller", 12000, "2024-06-12T19:50:30.789Z"),
]
STORES = {1: "Store A", 2: "Store B"}


def page_body(page):
    data = [
        {
            "store_id": store,
            "store_name": STORES[store],
            "purchase_id": f"{kind}{page}",
            "sales": amount,
            "time": time,
            "scale": scale,
        }
        for kind, store, scale, amount, time in PAGE_SALES
    ]
    envelope = {"page": page, "per_page": 1000, "total_pages": 10, "total_items": 10000}
    return json.dumps({**envelope, "data": data})


def connect(secret):
    return page_body


RATES_DOCUMENT = json.dumps(
    {"timestamp": 1718294400, "rates": {"JPY": 156.79364286, "EUR": 0.93, "USD": 1}}
)
DAY = "2024-06-13"
