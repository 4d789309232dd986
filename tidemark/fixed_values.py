"""Fixed values.

Everything in this file is vocabulary and numbers that results must carry exactly:
labels, placeholder strings, statistical constants, reason texts and report wording.
"""

# --- channels and events --------------------------------------------------------------

CHANNELS = ("paid_search", "organic_search", "referral", "direct", "other", "unknown")
PAID_CHANNELS = ("paid_search",)
UNKNOWN = "unknown"
TOTAL = "total"

PLACEHOLDER_MEDIA = ("<Other>", "(data deleted)", "(not set)", "NULL", "")
UNUSABLE_TRANSACTION_ID = "(not set)"

FUNNEL_EVENTS = ("view_item", "add_to_cart", "begin_checkout", "purchase")

# --- daily and weekly columns ---------------------------------------------------------

DAILY_COUNTS = (
    "sessions",
    "users",
    "view_item_sessions",
    "add_to_cart_sessions",
    "begin_checkout_sessions",
    "purchase_sessions",
    "purchases",
    "purchases_missing_revenue",
    "duplicate_purchase_events",
)
NEVER_ABOVE_SESSIONS = (
    "users",
    "view_item_sessions",
    "add_to_cart_sessions",
    "begin_checkout_sessions",
    "purchase_sessions",
    "purchases",
)
WEEKLY_SUMS = (
    "sessions",
    "view_item_sessions",
    "add_to_cart_sessions",
    "begin_checkout_sessions",
    "purchase_sessions",
    "purchases",
    "revenue",
    "spend",
    "purchases_missing_revenue",
    "duplicate_purchase_events",
)
RATIOS = (
    "conversion_rate",
    "aov",
    "cost_per_session",
    "cpa",
    "roas",
    "add_to_cart_rate",
    "checkout_rate",
    "purchase_rate",
    "missing_revenue_share",
)
SHARES = ("session_share", "revenue_share")
COST_RATIOS = ("cost_per_session", "cpa", "roas")
SPEND_BASED = ("spend", "cost_per_session", "cpa", "roas")
CHANGE_COLUMNS = ("sessions", "purchases", "revenue", "spend", *RATIOS)

# --- anomaly detection ----------------------------------------------------------------

DAILY_METRICS = (
    "sessions",
    "purchases",
    "revenue",
    "conversion_rate",
    "spend",
    "cost_per_session",
)
VOLUME_BASIS = {
    "sessions": "sessions",
    "purchases": "purchases",
    "revenue": "purchases",
    "conversion_rate": "purchase_sessions",
    "cost_per_session": "sessions",
}
MAD_TO_SIGMA = 0.6745
MEAN_AD_TO_SIGMA = 1.253314

# --- calendar -------------------------------------------------------------------------

NOTE_THANKSGIVING = "Thanksgiving to Cyber Monday (Black Friday period)"
NOTE_CHRISTMAS = "Christmas"
NOTE_DECEMBER = "holiday shopping season"
NOTE_NEW_YEAR = "New Year"
NOTE_BASELINE = "baseline window includes holiday-season days"

# --- validation reasons ---------------------------------------------------------------

REASON_DATE = "date: date outside {start}..{end}"
REASON_LABEL = "channel: unknown channel label"
REASON_NOT_PAID = "channel: not a paid channel"
REASON_NEGATIVE = "{column}: negative value"
REASON_MISSING = "{column}: missing value"
REASON_ABOVE_SESSIONS = "{column} > sessions"
REASON_NOT_SIMULATED = "is_simulated: is_simulated is not true"
REASON_DUPLICATE = "duplicate (date, channel)"

# --- facts ----------------------------------------------------------------------------

FACTS_VERSION = 1
PERCENT_METRICS = (
    "conversion_rate",
    "revenue_share",
    "session_share",
    "missing_revenue_share",
    "add_to_cart_rate",
    "checkout_rate",
    "purchase_rate",
)
MONEY_METRICS = ("revenue", "spend", "aov", "cpa", "cost_per_session")
FUNNEL_UNIT = "sessions"
FUNNEL_NOTE = (
    "A step can exceed the previous one because a session can start checkout "
    "with a cart filled in an earlier session."
)

# --- text checks ----------------------------------------------------------------------

ALLOWED_YEARS = (2020, 2021)

# --- report labels --------------------------------------------------------------------

DASH = "–"
ARROW_UP = "▲"
ARROW_DOWN = "▼"

CHANNEL_ORDER = ("organic_search", "referral", "direct", "paid_search", "other", "unknown")
CHANNEL_LABELS = {
    "organic_search": "Organic search",
    "referral": "Referral",
    "direct": "Direct",
    "paid_search": "Paid search",
    "other": "Other",
    "unknown": "Unknown",
    "total": "All channels",
}
RULE_LABELS = {
    "robust_z": "Unusual day",
    "cost_increase": "Cost increase",
    "conversion_drop": "Conversion drop",
    "revenue_share_shift": "Revenue share shift",
    "paid_spend_no_purchases": "Spend, no purchases",
    "tracking_gap": "Tracking gap",
}
METRIC_LABELS = {
    "sessions": "Sessions",
    "purchases": "Purchases",
    "revenue": "Revenue",
    "spend": "Spend",
    "conversion_rate": "Conversion rate",
    "cost_per_session": "Cost per session",
    "cpa": "CPA",
    "revenue_share": "Revenue share",
    "missing_revenue_share": "Purchases without revenue",
}
FUNNEL_STEPS = {
    "sessions": "All sessions",
    "view_item_sessions": "Viewed an item",
    "add_to_cart_sessions": "Added to cart",
    "begin_checkout_sessions": "Began checkout",
    "purchase_sessions": "Purchased",
}
KPI_CHANGES = {
    "wow_sessions": "Sessions",
    "wow_purchases": "Purchases",
    "wow_revenue": "Revenue",
    "wow_conversion_rate": "Conversion rate",
    "wow_aov": "Average order value",
}

# --- template wording -----------------------------------------------------------------

METRIC_WORDS = {
    "sessions": "sessions",
    "purchases": "purchases",
    "revenue": "revenue",
    "spend": "spend",
    "conversion_rate": "conversion rate",
    "cost_per_session": "cost per session",
    "cpa": "CPA",
    "revenue_share": "revenue share",
    "missing_revenue_share": "share of purchases without revenue",
}
SENTENCE_TOTALS = (
    "In {week}, the store recorded {sessions} sessions, {purchases} purchases "
    "and {revenue} in revenue."
)
SENTENCE_MOVE = "Revenue {revenue_move}{sessions_move} compared with {previous_week}."
SENTENCE_MOVE_SESSIONS = " and sessions {move}"
SENTENCE_NO_PREVIOUS = "There is no previous complete week to compare with."
SENTENCE_CONVERSION = "The overall conversion rate was {conversion_rate}%{aov}."
SENTENCE_AOV = " and the average order value was {aov}"
SENTENCE_SIMULATED = "Ad spend and spend-based metrics in this report are simulated."
SENTENCE_GAP = (
    "Revenue may be understated because {missing} purchases had no revenue recorded."
)
GAP_SENTENCE_FROM_PCT = 20
MOVE_UP = "rose {pct}%"
MOVE_DOWN = "fell {pct}%"
MOVE_NONE = "was unchanged"

FINDING_GAP = (
    "{value}% of purchases had no revenue recorded, "
    "which points to a tracking gap rather than lost sales."
)
FINDING_NO_PURCHASES = "{Channel} had simulated spend but no purchases this week."
FINDING_NO_PURCHASES_REAL = "{Channel} had spend but no purchases this week."
FINDING_COST = (
    "Simulated {metric} for {channel} rose {change_pct}% week over week to {shown_value}."
)
FINDING_COST_REAL = "{Metric} for {channel} rose {change_pct}% week over week to {shown_value}."
FINDING_CONVERSION = (
    "Conversion rate for {channel} fell {change_pct}% week over week "
    "while sessions were stable."
)
FINDING_SHIFT = (
    "The {channel} share of revenue moved {change_pp} percentage points to {value}%."
)
FINDING_DAY = (
    "{Channel} {metric}{simulated} on {when} was {shown_value} "
    "against a typical {shown_baseline}{context}."
)
FINDING_DAY_SIMULATED = " (simulated)"
FINDING_DAY_BASELINE = " (its comparison window includes holiday-season days)"
FINDING_DAY_SEASON = ", during the {season}"
FINDING_MOVER = "{Channel} revenue changed from {before} to {after} ({change_pct}%)."
FINDING_CHANNEL = (
    "{Channel} contributed {revenue_share}% of revenue from {session_share}% of sessions."
)

CHECK_BY_RULE = {
    "tracking_gap": "Check the purchase tracking setup, since revenue was not recorded for "
    "part of this week's purchases.",
    "paid_spend_no_purchases": "Check paid search tagging and conversion tracking, because "
    "simulated spend produced no recorded purchases.",
    "cost_increase": "Review the simulated paid search cost trend before changing budgets.",
    "revenue_share_shift": "Compare channel attribution with the previous week to understand "
    "the shift in revenue share.",
    "conversion_drop": "Look at landing pages and checkout for the channel whose conversion "
    "rate fell while traffic held steady.",
}
# The same for spend that is known to be real.
CHECK_BY_RULE_REAL = CHECK_BY_RULE | {
    "paid_spend_no_purchases": "Check paid search tagging and conversion tracking, because "
    "spend produced no recorded purchases.",
    "cost_increase": "Review the paid search cost trend before changing budgets.",
}
CHECK_SEASON = (
    "Compare holiday-period results with the same period in earlier data before "
    "treating seasonal peaks as unusual."
)
CHECK_UNKNOWN = (
    "Review the {unknown_share}% of sessions with an unknown channel to improve attribution."
)
CHECK_MAPPING = "Confirm the channel mapping still matches current campaign tagging."
CHECK_WAIT = "Wait for the next complete week before acting on single-week changes."

DISCLOSURE_MODEL = "Summary generated by an AI model from the numbers in this report."
DISCLOSURE_TEMPLATE = (
    "Summary generated from a fixed template because the AI summary was unavailable."
)
