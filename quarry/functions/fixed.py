"""Fixed values.

FIXED VALUES: the patterns, word lists and constants below must equal the
behaviour being reproduced (invoice rules, cleaning steps, profile flags), so
they are stated plainly, in their natural order, in one place. Everything else
in the package builds Spark expressions from them.

Patterns are written for Python ``re`` / Java ``java.util.regex`` alike; the
helpers in ``quarry.functions`` add the ``(?U)`` / ``(?i)`` flags.
"""

# ---------------------------------------------------------------- invoices --

MONTHS = r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"

# Date alternatives, tried in this order at each position (case-insensitive):
# D-M-Y, M-D-Y, Y-M-D, "D Mon Y", "Mon D, Y", "Mon-D-Y".
DATE_ALTERNATIVES = [
    r"\b((?:0?[1-9]|[12]\d|3[01])[/\-\.](?:0?[1-9]|1[0-2])[/\-\.](?:\d{4}|\d{2}))\b",
    r"\b((?:0?[1-9]|1[0-2])[/\-\.](?:0?[1-9]|[12]\d|3[01])[/\-\.](?:\d{4}|\d{2}))\b",
    r"\b(\d{4}[/\-\.](?:0?[1-9]|1[0-2])[/\-\.](?:0?[1-9]|[12]\d|3[01]))\b",
    r"\b((?:0?[1-9]|[12]\d|3[01])\s+" + MONTHS + r"\.?,?\s+\d{2,4})\b",
    r"\b(" + MONTHS + r"\.?\s+(?:0?[1-9]|[12]\d|3[01]),?\s+\d{2,4})\b",
    r"\b(" + MONTHS + r"[\./\-](?:0?[1-9]|[12]\d|3[01])[\./\-]\d{2,4})\b",
]

YEAR_ONLY = r"^(?:19|20)\d{2}$"

CURRENCY = r"(?:[\$€£]|RM|USD|EUR|GBP)"

# One amount token: optional currency, then EU grouped, US grouped,
# space grouped (incl. NBSP), simple 2-decimal, or a bare integer.
AMOUNT = (
    r"(?:[\$€£]|RM|USD|EUR|GBP)?\s*"
    r"(?:\d{1,3}(?:\.\d{3})+,\d{2}"
    r"|\d{1,3}(?:,\d{3})+(?:\.\d{2})?"
    r"|\d{1,3}(?:[\s\u00A0]\d{3})+(?:[.,]\d{2})?"
    r"|\d+[.,]\d{2}"
    r"|\d+)"
)
EU_GROUPED = r"^\d{1,3}(?:\.\d{3})+,\d{2}$"
EU_SIMPLE = r"^\d+,\d{2}$"

INVOICE_NUMBER_VALUE = r"^#?[A-Z0-9][A-Z0-9\-/]{2,19}$"
INVOICE_NUMBER_TRAILING = ":,.;"

# Layout-path label patterns, most specific first (full match, lower-cased).
NUMBER_LABELS = [
    r"invoice\s*(?:no|num|number|#)\.?",
    r"inv\s*(?:no|num|number|#)?\.?",
    r"bill\s*(?:no|number)\.?",
    r"reference\s*(?:no|number|#)\.?",
    r"ref\s*(?:no|#)?\.?",
    r"order\s*(?:no|number|#)\.?",
    r"po\s*(?:no|#)?\.?",
    r"no\.?",
]
INVOICE_DATE_LABELS = [
    r"date\s*of\s*issue",
    r"invoice\s*date",
    r"issue\s*date",
    r"bill\s*date",
    r"issued\s*on",
    r"dated",
    r"^date$",
]
DUE_DATE_LABELS = [
    r"due\s*date",
    r"payment\s*due(?:\s*date)?",
    r"pay\s*by",
    r"^due$",
]
ISSUER_LABELS = [
    r"seller", r"from", r"vendor", r"bill\s*from",
    r"issued\s*by", r"supplier", r"remit\s*to",
]
RECIPIENT_LABELS = [
    r"bill(?:ed)?\s*to", r"sold\s*to", r"ship(?:ped)?\s*to",
    r"invoice\s*to", r"issued\s*to", r"client", r"customer",
    r"recipient", r"attention", r"attn", r"^to$",
]
TOTAL_LABELS = [
    r"grand\s*total", r"total\s*due", r"amount\s*due",
    r"balance\s*due", r"total\s*amount", r"total\s*payable",
    r"^total$", r"total",
]
SUBTOTAL = r"sub\s*total"

# Rows starting with these words end an issuer / recipient block.
STOP_ROW = (
    r"^(tax\s*id|vat(?:\s*no)?|iban|swift|phone|tel|fax|email|e-?mail"
    r"|website|www\.|http|payment|bank|account|contact|reg(?:istration)?"
    r"|invoice|items?|description|qty|quantity|date)\b"
)
PARTY_CUT = r"\b(tax\s*id|vat|iban|phone|tel|email|bank)\b"
PARTY_STRIP_CHARS = " :,-"
DOC_TYPE_WORD = r"(invoice|receipt|bill|statement|tax\s*invoice)"
DOC_TYPE_SUFFIX = r"\s+(INVOICE|RECEIPT|BILL|STATEMENT|TAX\s*INVOICE|QUOTATION|QUOTE)\s*$"
HEADER_MONEY = r"[\$€£]|\d[.,]\d{2}"
HASH_NUMBER_WORD = r"#([A-Z0-9][A-Z0-9\-/]{2,19})"

# Layout geometry constants.
DEFAULT_LINE_HEIGHT = 12.0
MIN_Y_OVERLAP = 0.5
ROW_TOL_FACTOR = 0.6
RIGHT_SLACK = 2.0
ROW_START_GAP = 5.0
SPAN_MAX_EXTRA_WORDS = 4
TOTAL_SPAN_MAX_EXTRA_WORDS = 3
VALUE_ROWS_BELOW = 4
BLOCK_ROWS_BELOW = 6
TOTAL_ROWS_BELOW = 2
VALUE_COL_TOL = (60.0, 5.0)   # max(60, 5 * line height)
BLOCK_COL_TOL = (50.0, 4.0)   # max(50, 4 * line height)
BLOCK_X_RIGHT = 300.0
HEADER_FRACTION = 0.25
OCR_MIN_CONF = 30
READING_ORDER_MIN_TOL = 3.0

# Text-path label patterns (searched per line, case-insensitive).
TEXT_NUMBER_LABEL = (
    r"(?:invoice\s*(?:no|number|num|#)|inv\s*[#:]|bill\s*no|\bno\.)"
    r"\.?\s*[:#]?\s*"
)
TEXT_NUMBER_VALUE = r"(#?[A-Z0-9][A-Z0-9\-/]{2,19})"
TEXT_HASH_NUMBER = r"(?<![A-Za-z0-9])#(\d{3,})\b"
TEXT_DUE_LABEL = r"\b(due\s*date|payment\s*due|pay\s*by)\b"
TEXT_ISSUE_LABEL = r"\b(invoice\s*date|date\s*of\s*issue|issue\s*date|bill\s*date|date)\b"
TEXT_RECIPIENT_LABEL = (
    r"(?:bill(?:ed)?\s*to|sold\s*to|ship\s*to|invoice\s*to|issued\s*to"
    r"|client|customer|recipient)\s*[:\-]?\s*(.*)"
)
TEXT_SELLER_LABEL = r"^\s*(seller|from|vendor|bill\s*from|issued\s*by)\s*[:\-]?\s*(.*)"
TEXT_TOTAL_LABEL = r"\b(grand\s*total|total\s*due|amount\s*due|balance\s*due|total)\b"
TEXT_RECIPIENT_NEXT_LINES = 3
TEXT_ISSUER_NEXT_LINES = 4
TEXT_ISSUER_TOP_LINES = 15
TEXT_ISSUER_MIN_LEN = 4

FIELDS = ["invoice_number", "invoice_date", "due_date", "issuer", "recipient", "total"]

# Gold JSON keys per field, first non-empty wins.
GOLD_KEYS = {
    "invoice_number": ["INVOICE_NUMBER"],
    "invoice_date": ["DATE", "DATE_ISSUED", "INVOICE_DATE", "PAYMENT_DATE"],
    "due_date": ["DUE_DATE", "PAYMENT_DUE_DATE"],
    "total": ["TOTAL_AMOUNT", "TOTAL", "TOTALS", "GRAND_TOTAL"],
    "issuer": ["ISSUER", "COMPANY", "FROM", "VENDOR"],
    "recipient": ["BILLED_TO", "BILL_TO", "ISSUED_TO", "CUSTOMER_NAME", "RECIPIENT"],
}
# Nested gold paths (labeled image sheet).
GOLD_PATHS = {
    "invoice_number": "$.invoice.invoice_number",
    "invoice_date": "$.invoice.invoice_date",
    "due_date": "$.invoice.due_date",
    "issuer": "$.invoice.seller_name",
    "recipient": "$.invoice.client_name",
    "total": "$.subtotal.total",
}

# ------------------------------------------------------- classifier text --

MAX_WORDS = 500
HYPHEN_BREAK = "-\n"

# Invoice signal tokens, in order, with their (case-insensitive) patterns.
INVOICE_SIGNALS = [
    ("__inv_number__", r"\b(invoice\s*n[o0]\.?|inv[- #]|invoice\s*#|invoice\s*number|bill\s*no)\b"),
    ("__inv_header__", r"\b(tax\s*invoice|commercial\s*invoice|invoice\b)"),
    ("__bill_to__", r"\b(bill\s*to|billed\s*to|sold\s*to|issued\s*to|invoiced\s*to)\b"),
    ("__amount_due__", r"\b(amount\s*due|balance\s*due|total\s*amount\s*due|total\s*due)\b"),
    ("__grand_total__", r"\b(grand\s*total|total\s*amount|subtotal|sub\s*total)\b"),
    ("__due_date__", r"\b(due\s*date|payment\s*due|pay\s*by|payment\s*terms)\b"),
    ("__remit__", r"\b(remit\s*payment|please\s*pay|please\s*remit|kindly\s*remit)\b"),
    ("__po_number__", r"\b(purchase\s*order|po\s*number|po\s*#|po\s*no)\b"),
    ("__vat__", r"\b(vat|gst|sales\s*tax)\b"),
    ("__net_terms__", r"\bnet\s*\d{1,3}\b"),
]
SIGNAL_TOKEN = r"__[a-z_]+__"
INVOICE_OVERRIDE_MIN_SIGNALS = 4
OCR_MIN_TEXT_CHARS = 40

# ------------------------------------------------------------- profiling --

# Structure flags (name, pattern, case-insensitive?). The forward, month-name
# and bracket-redaction patterns are written as intended (the originals held
# escape slips).
NEWS_FLAGS = [
    ("has_numbers", r"\d", False),
    ("has_dates", r"\b\d{4}\b", False),
    ("has_url", r"http|www", False),
]
EMAIL_FLAGS = [
    ("has_email", r"\b[\w\.-]+@[\w\.-]+\.\w+\b", False),
    ("has_url", r"http[s]?://|www\.", False),
    ("has_phone", r"\+?\d[\d\-\s]{7,}\d", False),
    ("has_numbers", r"\d", False),
    ("has_currency", r"[$€£]", False),
    ("has_subject_word", r"\bsubject\b", True),
    ("has_from_word", r"\bfrom\b", True),
    ("has_to_word", r"\bto\b", True),
    ("has_cc_word", r"\bcc\b", True),
    ("has_forward", r"\bfw:|\bfwd:", True),
    ("has_reply", r"\bre:", True),
    ("has_attachment_word", r"\battachment\b|\battached\b", True),
]
CONTRACT_FLAGS = [
    ("has_agreement_word", r"\bagreement\b", True),
    ("has_shall", r"\bshall\b", True),
    ("has_termination", r"\btermination\b", True),
    ("has_governing_law", r"\bgoverning law\b", True),
    ("has_party", r"\bparty\b|\bparties\b", True),
    ("has_section", r"\bsection\b|\barticle\b", True),
    ("has_currency", r"[$€£]", False),
    ("has_dates", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b|\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", True),
    ("has_omitted", r"<omitted>", True),
    ("has_redaction", r"\*{3,}|_{3,}|\[\*\s*\*\s*\*\]", False),
]
INVOICE_TERMS = [
    ("has 'invoice'", r"\binvoice\b"),
    ("has total/amount", r"\b(total|amount)\b"),
    ("has 'bill to'", r"\bbill\s*to\b"),
    ("has 'due date'", r"\bdue\s*date\b"),
    ("has 'payment'", r"\bpayment\b"),
    ("has subtotal", r"\bsubtotal\b"),
    ("has tax/vat", r"\b(tax|vat|gst)\b"),
    ("has currency symbol", r"[\$\€\£]"),
    ("has numeric amount", r"\d+[\.,]\d{2}"),
]

# Ordered keywords for guessing a contract type from its name.
CONTRACT_TYPES = [
    "license", "service", "supply", "development", "marketing", "distribution",
    "consulting", "manufacturing", "franchise", "hosting", "maintenance",
    "joint venture", "collaboration", "promotion", "outsourcing", "sponsorship",
    "strategic alliance", "transportation", "agency", "endorsement", "ip",
]

# Per-class word limits used when filtering long documents.
MAX_WORDS_BY_CLASS = {"email": 5000, "contract": 30000}
MIN_WORDS = 5

# --------------------------------------------------------------- features --

MIN_DF = 3
MAX_FEATURES = 20000
SPLIT_FRACTIONS = (0.70, 0.15, 0.15)
SEED = 42
CV_FOLDS = 5

# The English stop-word list of Spark ML's StopWordsRemover,
# stated here so that importing the queries needs no session and no jar.
SPARK_ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split())
