"""Fixed values.  These must stay exactly as written for results to agree
with the operators' definitions (class thresholds, bit masks, state labels)."""

# --- fixed values: scoring classes, highest first -------------------------
SCORING_THRESHOLDS = [(20.0, "star"), (15.0, "good"), (10.0, "average")]
SCORING_DEFAULT = "bad"
RATING_THRESHOLDS = [(8.0, "star"), (7.0, "good"), (6.0, "average")]
RATING_DEFAULT = "bad"

# --- fixed values: 32-day activity bitmap (bit 31 = the as-of day) --------
DATELIST_DAYS = 32
MASK_LAST_7_DAYS = 4261412864          # bits 31..25
MASK_DAYS_8_TO_14 = 33292288           # bits 24..18
MASK_TODAY = 2147483648                # bit 31

# --- fixed values: growth-accounting states -------------------------------
STATE_NEW = "New"
STATE_RETAINED = "Retained"
STATE_RESURRECTED = "Resurrected"
STATE_CHURNED = "Churned"
STATE_STALE = "Stale"
ACTIVE_STATES = ["Retained", "Resurrected", "New"]

# --- fixed values: career state labels ------------------------------------
CAREER_NEW = "New"
CAREER_RETIRED = "Retired"
CAREER_CONTINUED = "Continued Playing"
CAREER_RETURNED = "Returned from Retirement"
CAREER_STAYED_RETIRED = "Stayed Retired"
CAREER_UNKNOWN = "Unknown"

# --- fixed values: grouping-set labels -------------------------------------
OVERALL = "(overall)"
UNKNOWN = "unknown"

# --- fixed values: free-text flags in box-score comments -------------------
DID_NOT_PLAY = "DNP"
DID_NOT_DRESS = "DND"
NOT_WITH_TEAM = "NWT"

# --- fixed values: referrer channel rules (substring -> channel), in order --
REFERRER_RULES = [
    ("linkedin", "Linkedin"),
    ("t.co", "Twitter"),
    ("google", "Google"),
    ("lnkd", "Linkedin"),
]

# fixed values: the label of a change, by "was active, is active"
PERIOD_CHANGES = {"none true": CAREER_NEW, "true false": CAREER_RETIRED, "false true": CAREER_RETURNED,
                  "false false": CAREER_STAYED_RETIRED}
INTERVAL_CHANGES = PERIOD_CHANGES | {"true true": CAREER_CONTINUED}
