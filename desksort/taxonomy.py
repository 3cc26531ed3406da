"""Ticket categories and the word tables that sort tickets into them.

Every table here is a default: each operator that uses one takes it as a
parameter, so another help desk can bring its own.
"""

from __future__ import annotations

# Category names, in taxonomy order. The order breaks ties
# between equal keyword scores.
CATEGORIES = (
    "Billing & Payments",
    "Account Access / Login Issues",
    "Bug / Defect Reports",
    "Feature Requests",
    "Integration Issues",
    "Performance Problems",
    "Security & Compliance",
    "How-To / Product Usage Questions",
    "General Inquiries / Other",
)

GENERAL = "General Inquiries / Other"
UNCATEGORIZED = "Uncategorized"

# Fragments of a feed's own category names, in the order they
# are tried; the first one contained in the lower-cased name wins.
CATEGORY_FRAGMENTS = (
    (
        "Account Access / Login Issues",
        ("account", "login", "password", "access", "authentication", "credentials", "sso", "mfa"),
    ),
    (
        "Bug / Defect Reports",
        ("incident", "bug", "error", "defect", "issue", "problem", "failure", "broken"),
    ),
    (
        "How-To / Product Usage Questions",
        ("service request", "request", "how to", "question", "help", "inquiry", "information"),
    ),
    ("Feature Requests", ("enhancement", "feature", "improvement", "change request")),
    ("Performance Problems", ("performance", "slow", "timeout", "latency", "degradation")),
    ("Integration Issues", ("integration", "api", "webhook", "sync", "connection")),
    (
        "Security & Compliance",
        ("security", "compliance", "audit", "privacy", "gdpr", "hipaa"),
    ),
    (
        "Billing & Payments",
        ("billing", "payment", "invoice", "subscription", "charge", "refund"),
    ),
)

# Keywords per category; a hit scores the keyword's word count.
KEYWORDS = {
    "Billing & Payments": (
        "billing", "payment", "invoice", "refund", "charge", "subscription",
        "price", "pricing", "cost", "fee", "card", "transaction", "pay",
    ),
    "Account Access / Login Issues": (
        "login", "password", "access", "authentication", "mfa", "2fa",
        "sso", "locked", "lock", "username", "sign in", "credentials",
    ),
    "Bug / Defect Reports": (
        "bug", "error", "broken", "crash", "fail", "not working",
        "issue", "problem", "defect", "wrong", "incorrect", "glitch",
    ),
    "Feature Requests": (
        "feature", "enhancement", "improvement", "suggestion", "request",
        "would like", "please add", "missing", "need",
    ),
    "Integration Issues": (
        "api", "integration", "webhook", "sync", "connect", "third party",
        "external", "endpoint", "oauth", "rest",
    ),
    "Performance Problems": (
        "slow", "performance", "timeout", "latency", "lag", "loading",
        "freeze", "hang", "speed", "delay",
    ),
    "Security & Compliance": (
        "security", "privacy", "gdpr", "hipaa", "compliance", "encrypt",
        "breach", "vulnerability", "audit", "unauthorized",
    ),
    "How-To / Product Usage Questions": (
        "how to", "how do", "help", "guide", "tutorial", "setup",
        "configure", "use", "using", "question", "explain",
    ),
}

# Priority spellings, compared in lower case.
PRIORITY_SPELLINGS = {
    "High": ("high", "critical", "urgent", "1"),
    "Medium": ("medium", "normal", "2"),
    "Low": ("low", "3"),
}
DEFAULT_PRIORITY = "Medium"

# Parts of column names that mark a column's role in a feed.
ROLE_NAMES = {
    "title": ("title", "subject", "summary", "short_description", "ticket_title"),
    "description": (
        "description", "details", "body", "text", "long_description",
        "ticket_description", "document",
    ),
    "category": ("category", "type", "ticket_type", "classification", "class", "topic_group"),
    "priority": ("priority", "severity", "urgency"),
}

# What the standardised table says about where a ticket is from.
TICKET_ID_PREFIX = "it_service_"
CUSTOMER_EMAIL = "customer@company.com"
CUSTOMER_NAME = "IT User"
FEED_NAME = "kaggle_it_service"
