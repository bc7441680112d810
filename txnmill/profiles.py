"""Rule profiles: what a full load and an incremental load accept."""

from dataclasses import dataclass

# Lists, patterns and messages that downstream consumers rely on.
CURRENCIES = ["USD", "EUR", "GBP", "CHF", "JPY", "AUD", "CAD"]
TRANSACTION_TYPES = ["debit", "credit"]
MERCHANT_CATEGORIES = [
    "e-commerce",
    "travel",
    "food_and_beverage",
    "groceries",
    "electronics",
    "retail",
    "entertainment",
    "health",
    "transportation",
    "home_and_garden",
    "payroll",
    "transfer",
]
STATUSES = ["completed", "pending", "failed", "reversed"]
COUNTRY_CODES = """
    AD AE AF AG AI AL AM AO AR AT AU AZ BA BB BD BE BF BG BH BI BJ BN BO BR BS BT BW BY BZ
    CA CD CF CG CH CI CL CM CN CO CR CU CV CY CZ DE DJ DK DM DO DZ EC EE EG ER ES ET
    FI FJ FM FR GA GB GD GE GH GM GN GQ GR GT GW GY HK HN HR HT HU ID IE IL IN IQ IR IS IT
    JM JO JP KE KG KH KI KM KN KP KR KW KZ LA LB LC LI LK LR LS LT LU LV LY
    MA MC MD ME MG MH MK ML MM MN MR MT MU MV MW MX MY MZ NA NE NG NI NL NO NP NR NZ OM
    PA PE PG PH PK PL PT PW PY QA RO RS RW SA SB SC SD SE SG SI SK SL SM SN SO SR SS ST SV SY SZ
    TD TG TH TJ TL TN TO TR TT TV TW TZ UA UG US UY UZ VA VC VE VN VU WS YE ZA ZM ZW
""".split()
LOWEST_ACCOUNT, HIGHEST_ACCOUNT = "ACC-1001", "ACC-1020"
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Patterns are anchored with \A and \z: in Java regexes `$` would also accept a trailing line break.
ID_REGEX = r"\ATXN-[A-Z0-9]+\z"
ACCOUNT_REGEX = r"\AACC-(\d{4})\z"
DATE_REGEX = (
    r"\A\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\dZ\z"
)
COUNTRY_REGEX = r"\A[A-Z]{2}\z"


@dataclass(frozen=True)
class Profile:
    """Where the two kinds of load differ."""

    name: str
    cleans_text: bool  # strip fields and upper-case ids before landing
    first_ts: str
    last_ts: str
    range_message: str
    amount_regex: str
    amount_type_message: str  # not a decimal(18,2)
    amount_form_message: str  # a decimal, but not written as the profile wants
    sign_before_form: bool  # which of the two last amount checks comes first


# Date bounds, amount forms and messages of each profile.
FULL = Profile(
    name="full",
    cleans_text=False,
    first_ts="2024-01-01 00:00:00",
    last_ts="2024-03-31 23:59:59",
    range_message="transaction_date falls outside expected Jan-Mar 2024 range",
    amount_regex=r"\A\d+(\.\d{1,2})?\z",
    amount_type_message="amount is not a valid decimal",
    amount_form_message="amount must have at most 2 decimal places",
    sign_before_form=True,
)
INCREMENTAL = Profile(
    name="incremental",
    cleans_text=True,
    first_ts="2024-01-01 00:00:00",
    last_ts="2024-12-31 23:59:59",
    range_message="transaction_date falls outside expected loadable range",
    amount_regex=r"\A-?\d+(\.\d{1,2})?\z",
    amount_type_message="amount must be a valid decimal with at most 2 decimal places",
    amount_form_message="amount must be a valid decimal with at most 2 decimal places",
    sign_before_form=False,
)
