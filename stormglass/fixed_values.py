"""Word lists, patterns, maps and constants that define the results.

They are data, not logic. Changing any of them changes query results.
"""

# --- Fixed values: category of an archived article, by theme substring. First match wins.
BATCH_CATEGORIES = [
    ("CONFLICT", "MILITARY|WAR|WEAPON|MISSILE|INVASION|AIRSTRIKE"),
    ("ECONOMIC_PRESSURE", "SANCTION|EMBARGO|TARIFF|EXPORT_CONTROL"),
    ("POLITICAL_INSTABILITY", "COUP|PROTEST|RIOT"),
    ("DIPLOMATIC_TENSION", "DIPLOMATIC|EXPULSION"),
    ("DEESCALATION", "CEASEFIRE"),
    ("INTELLIGENCE_CYBER", "ESPIONAGE|CYBERATTACK"),
    ("SPECIAL", "NUCLEAR|BLOCKADE|ANNEXATION"),
]

# --- Fixed values: category of a live article, by theme substring. First match wins.
LIVE_CATEGORIES = [
    ("Military", "MILITARY|WAR|WEAPON|MISSILE|INVASION"),
    ("Sanctions", "SANCTION|EMBARGO|TARIFF"),
    ("Diplomatic", "DIPLOMATIC|EXPULSION"),
    ("Nuclear", "NUCLEAR"),
    ("Political", "COUP|PROTEST"),
]
LIVE_CATEGORY_OTHER = "Other"

# --- Fixed values: words a live article must show in its themes, and in its URL.
LIVE_THEME_WORDS = (
    "MILITARY|WAR|WEAPON|MISSILE|SANCTION|EMBARGO|COUP|PROTEST|DIPLOMATIC|NUCLEAR|CYBERATTACK"
)
LIVE_URL_WORDS = (
    "war|attack|sanction|missile|nuclear|military|conflict|invasion|protest|coup|strike|troops|"
    "weapon|crisis|threat|bomb|terror|drone|ceasefire|diplomacy|nato|un |iran|russia|china|"
    "israel|ukraine|gaza|korea"
)

# --- Fixed values: patterns on themes and titles.
NON_US_COUNTRY = "#(?!US)[A-Z]{2}#"
HEX_ONLY_TITLE = r"^[A-Fa-f0-9\s]+$"
NUMBERED_TITLE = r"^[A-Z][a-z]* \d+$"
WEB_REMNANT = r"#|\.com|\.org|\.net"
HEX_RUN = "[A-Fa-f0-9]{6,}"
ARTICLE_PLACEHOLDER = "^Article [A-Z][a-z]+ [A-Z][a-z]+"

# --- Fixed values: generic words that are not proper nouns of an event label.
LABEL_STOPWORDS = [
    "war", "tensions", "protests", "crisis", "escalation", "airstrikes", "peak", "ceasefire",
    "civil", "political", "geopolitical", "border", "strait",
]

# --- Fixed values: a supporting article must mention one of these.
CONFLICT_WORDS = [
    "attack", "missile", "strike", "military", "troops", "invasion", "bomb", "nuclear", "riot",
    "clash", "conflict", "threat", "shoot", "kill", "dead", "wound", "protest", "warn", "launch",
]

# --- Fixed values: words ignored when a label is made from title words.
TITLE_STOPWORDS = [
    "the", "and", "for", "are", "was", "has", "had", "with", "that", "this", "from", "have",
    "been", "will", "its", "not", "but", "they", "their", "said", "says", "over", "after", "more",
    "also", "than", "into", "about",
]
TITLE_WORD = "[a-z]{4,}"
LABEL_SEPARATOR = " · "
FALLBACK_LABEL = "Geopolitical Event"

# --- Fixed values: sector of a ticker.
SECTOR_TICKERS = {
    "Defense": ["LMT", "RTX", "NOC", "GD", "HII", "BA", "TDG", "LHX"],
    "Energy": ["XOM", "CVX", "COP", "OXY", "SLB", "EOG", "PSX", "VLO", "MPC"],
    "Gold/Safe Haven": ["NEM", "FCX", "KO", "PG", "JNJ", "CL", "GIS"],
    "Tech": ["AAPL", "MSFT", "GOOGL", "GOOG", "META", "AMZN", "NVDA", "ORCL", "CRM"],
    "Semiconductors": ["AMD", "INTC", "QCOM", "NXPI", "AMAT", "LRCX", "MCHP", "TXN"],
    "Airlines": ["AAL", "UAL", "DAL", "LUV", "NCLH", "RCL", "CCL"],
}

# --- Fixed values: exchange traded fund that stands for a sector.
SECTOR_FUNDS = {
    "Airlines": "JETS",
    "Semiconductors": "SOXX",
    "Energy": "XLE",
    "Defense": "ITA",
    "Tech": "XLK",
    "Gold/Safe Haven": "GLD",
}

# --- Fixed values: known events by spike date.
KNOWN_EVENTS = {
    "2018-01-02": "Iran Protests",
    "2018-04-16": "Syria Airstrikes",
    "2018-05-15": "Gaza Border Protests",
    "2019-07-01": "Iran Strait of Hormuz",
    "2019-08-13": "Hong Kong Protests",
    "2019-10-03": "Hong Kong Protests Peak",
    "2019-10-04": "Hong Kong Protests Peak",
    "2022-01-06": "Russia-Ukraine Tensions",
    "2022-02-13": "Russia-Ukraine Escalation",
    "2022-02-18": "Russia-Ukraine Escalation",
    "2022-02-25": "Russia-Ukraine War",
    "2022-07-09": "Sri Lanka Political Crisis",
    "2023-03-28": "Russia-Ukraine · NATO · Israel",
    "2023-05-04": "Sudan Civil War",
    "2023-10-18": "Israel-Hamas War",
    "2023-11-24": "Israel-Hamas Ceasefire",
    "2024-04-26": "Iran-Israel Tensions",
    "2024-04-29": "Iran-Israel Tensions",
    "2024-04-30": "Iran-Israel Tensions",
    "2024-05-01": "Iran-Israel Tensions",
    "2024-05-02": "Iran-Israel Tensions",
    "2024-08-01": "Russia Ukraine Escalation",
    "2024-08-05": "Russia Ukraine Escalation",
    "2025-06-09": "Iran War",
    "2025-06-10": "Iran War",
    "2025-06-11": "Iran War",
    "2025-06-12": "Iran War",
    "2025-09-09": "Russia Ukraine Tensions",
    "2025-10-02": "Russia Ukraine Tensions",
    "2026-01-12": "Iran War Escalation",
    "2026-01-14": "Iran War Escalation",
}

# --- Fixed values: sample portfolio, ticker and weight in percent.
SAMPLE_PORTFOLIO = [("AAPL", 30.0), ("XOM", 50.0), ("LMT", 20.0)]

# --- Fixed values: numeric parameters.
TONE_MIN, TONE_MAX = 0.0, 50.0
INDEX_MAX = 10.0
LOW_PERCENTILE, HIGH_PERCENTILE = 0.01, 0.99
SPIKE_SIGMAS = 3.0
MEDIUM_RISK_SIGMAS = 1.5
PRICE_WINDOW = (-30, 30)
NEWS_WINDOW = (-3, 3)
CHART_WINDOW = (-5, 5)
NEWS_PER_SPIKE = 50
TARGET_OFFSET = 5
BAR_PIXELS = 180
FIRST_YEAR, LAST_YEAR = 2016, 2026
NEW_YORK = "America/New_York"
