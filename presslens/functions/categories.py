"""Category names, orders and groupings used with recode, bins and sorts."""

from __future__ import annotations

# Organisation types by sector; types not listed have no sector.
ORG_TYPES_BY_SECTOR = {
    "Technology": [
        "tech", "web", "information technology", "hosting provider", "Information Security",
        "software", "Network Monitoring", "web service", "tech, web", "web, tech", "web, gaming",
        "messaging app", "QR code payment", "social networking", "social network", "social media",
        "telecoms", "telecommunications", "telecom", "mobile carrier",
    ],
    "Retail": [
        "retail", "tech, retail", "shopping", "online shopping", "fashion", "phone accessories",
        "Consumer Goods", "restaurant", "hotel",
    ],
    "Government": [
        "government", "government, database", "government, military", "military", "web, military",
        "special public corporation", "political",
    ],
    "Healthcare": [
        "healthcare", "health", "government, healthcare", "military, healthcare",
        "Clinical Laboratory",
    ],
    "Finance": [
        "financial", "banking", "financial, credit reporting", "financial service company",
    ],
    "others": [
        "advertising", "transport", "gaming", "game", "dating", "academic",
        "educational services", "gambling", "energy", "background check",
        "consulting, accounting", "data broker",
        "personal and demographic data about residents and their properties of US",
        "humanitarian", "local search", "publisher (magazine)", "genealogy", "media",
        "Question & Answer", "market analysis", "ticket distribution", "Telephone directory",
        "online marketing", "arts group", "various",
    ],
}

# Sectors of the second event list; sectors not listed stay as they are.
SECTOR_NAMES = {
    "Government": ["government", "military", "government, military"],
    "Retail": ["retail"],
    "Finance": ["finance"],
    "Healthcare": ["health ", "misc, health"],
    "Technology": [
        "web", "web ", "tech", "tech, app", "tech, web", "web, tech", "app", "web, gaming",
    ],
}

SENSITIVITY_NAMES = {
    0.0: "Unknown",
    1.0: "Just email address/Online information",
    2.0: "SSN/Personal details",
    3.0: "Credit card information",
    4.0: "Health & other personal records",
    5.0: "Full details",
}

SIZE_RANGES = [
    "1 - 10", "11 - 50", "51 - 200", "201 - 500", "501 - 1000", "1001 - 5000", "5001 - 10000",
    "10001+",
]

RECORDS_LOST_EDGES = [
    0, 1000, 10000, 100000, 1000000, 2500000, 5000000, 10000000, 25000000, 50000000, 100000000,
    float("inf"),
]
RECORDS_LOST_LABELS = [
    "0-1K", "1K-10K", "10K-100K", "100K-1M", "1M-2.5M", "2.5M-5M", "5M-10M", "10M-25M",
    "25M-50M", "50M-100M", "100M+",
]

REPORTED_INDUSTRIES = [
    "internet", "consumer electronics", "retail", "marketing and advertising", "automotive",
    "financial services", "entertainment", "computer software",
    "information technology and services", "restaurants", "airlines/aviation",
    "telecommunications", "oil & energy", "aviation & aerospace", "broadcast media",
]


def lookup(groups: dict[str, list[str]]) -> dict[str, str]:
    """{member: group} for recode."""
    return {member: group for group, members in groups.items() for member in members}
