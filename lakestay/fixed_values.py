"""Names, lists and constants that results depend on.

Everything in this module is data that has to be exactly as it is for results
to be right. There is no logic here.
"""

# Lake layers, in flow order.
LAYERS = ("raw", "bronze", "rejected", "silver", "quarantine")

# Column names used for provenance and data quality.
CORRUPT = "_corrupt_record"
BATCH_DATE = "_batch_date"
DQ_REASON = "_dq_reason"
DUPLICATE_KEY = "DUPLICATE_KEY"
META_COLUMNS = ("_source_file", "_ingested_at", "_batch_date")

# Text shapes accepted for dates and times.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Sentinel dates of open-ended dimension versions.
MIN_DATE = "1970-01-01"
MAX_DATE = "9999-12-31"

# Largest tolerated share of rows failing a data-quality rule.
MAX_REJECT_RATIO = 0.2
MAX_REJECT_RATIO_RELAXED = 0.5

# Landing sources: (file format, XML row tag, optional).
SOURCE_FORMATS = {
    "bookings": (("csv", None, True), ("xml", "booking", True)),
    "hotels": (("xml", "hotel", False),),
    "payments": (("csv", None, False),),
    "customers": (("csv", None, False),),
    "clickstream": (("csv", None, False),),
}

# Raw columns each source must deliver.
RAW_COLUMNS = {
    "bookings": (
        "booking_id", "hotel_id", "user_id", "room_type", "checkin_date", "checkout_date",
        "total_amount", "currency", "booking_status", "source_channel", "payment_method",
        "created_at",
    ),
    "hotels": (
        "hotel_id", "hotel_name", "hotel_tier", "star_rating", "city", "country", "region",
        "latitude", "longitude", "total_rooms", "facilities", "partner_since", "is_active",
    ),
    "payments": (
        "payment_id", "booking_id", "amount", "currency", "payment_method", "payment_status",
        "gateway_code", "processed_at", "refund_amount", "refund_at",
    ),
    "customers": (
        "user_id", "full_name", "email", "phone", "country", "user_segment", "loyalty_tier",
        "loyalty_points", "first_booking_date", "total_bookings", "is_active", "registered_at",
    ),
    "clickstream": (
        "event_id", "session_id", "user_id", "event_type", "page_url", "hotel_id",
        "search_query", "device_type", "os", "event_timestamp",
    ),
}

# Accepted spellings of booleans.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")

# Booking status: spelling (upper case) -> canonical status.
STATUS_SPELLINGS = {
    "CONFIRMED": "CONFIRMED",
    "CONFIRM": "CONFIRMED",
    "1": "CONFIRMED",
    "CANCELLED": "CANCELLED",
    "CANCELED": "CANCELLED",
    "CANCEL": "CANCELLED",
    "PENDING": "PENDING",
    "NO_SHOW": "NO_SHOW",
}
STATUS_OTHER = "UNKNOWN"

# Booking channel: spelling (lower case) -> canonical channel; names starting
# with the prefix are partner channels.
CHANNEL_SPELLINGS = {
    "app_ios": "Mobile App",
    "app_android": "Mobile App",
    "mobile app": "Mobile App",
    "web": "Web",
    "website": "Web",
}
CHANNEL_PARTNER_PREFIX = "partner"
CHANNEL_PARTNER = "Partner API"
CHANNEL_OTHER = "Other"

# Web session device -> channel id.
DEVICE_CHANNELS = {"mobile": 2, "tablet": 2, "desktop": 1}
CHANNEL_ID_OTHER = 4

# Season by month.
SEASON_MONTHS = {"high_season": (6, 7, 8, 12), "shoulder": (1, 2, 9)}
SEASON_OTHER = "low_season"

# Rules per entity: (reason code, condition of a bad row).
DQ_RULES = {
    "bookings": (
        ("MISSING_BOOKING_ID", "booking_id IS NULL"),
        ("MISSING_HOTEL_ID", "hotel_id IS NULL"),
        ("INVALID_DATE", "checkin_date IS NULL OR checkout_date IS NULL"),
        ("NON_POSITIVE_NIGHTS", "nights IS NULL OR nights <= 0"),
        ("INVALID_AMOUNT", "total_amount IS NULL"),
        ("MISSING_CURRENCY", "currency IS NULL"),
    ),
    "hotels": (
        ("MISSING_HOTEL_ID", "hotel_id IS NULL"),
        ("MISSING_HOTEL_NAME", "hotel_name IS NULL"),
        ("INVALID_STAR_RATING", "star_rating IS NULL OR star_rating < 1 OR star_rating > 5"),
        ("INVALID_TOTAL_ROOMS", "total_rooms IS NULL OR total_rooms <= 0"),
    ),
    "payments": (
        ("MISSING_PAYMENT_ID", "payment_id IS NULL"),
        ("MISSING_BOOKING_ID", "booking_id IS NULL"),
        ("INVALID_AMOUNT", "amount IS NULL"),
        ("INVALID_PROCESSED_AT", "processed_at IS NULL"),
    ),
    "customers": (
        ("MISSING_USER_ID", "user_id IS NULL"),
        ("MISSING_EMAIL", "email_hash = ''"),
    ),
    "clickstream": (
        ("MISSING_EVENT_ID", "event_id IS NULL"),
        ("MISSING_SESSION_ID", "session_id IS NULL"),
        ("INVALID_TIMESTAMP", "event_timestamp IS NULL"),
        ("MISSING_EVENT_TYPE", "event_type IS NULL"),
    ),
}

# Business key and recency column per entity.
ENTITY_KEYS = {
    "bookings": ("booking_id", "created_at"),
    "hotels": ("hotel_id", "_ingested_at"),
    "payments": ("payment_id", "processed_at"),
    "customers": ("user_id", "_ingested_at"),
    "clickstream": ("event_id", "event_timestamp"),
}

# Staging contract: data columns in order, followed by these provenance columns.
STAGING_META = ("_ingested_at", "_source_file", "_batch_date")
STAGING_COLUMNS = {
    "bookings": (
        "booking_id", "hotel_id", "user_id", "room_type", "checkin_date", "checkout_date",
        "total_amount", "currency", "booking_status", "booking_channel", "payment_method",
        "nights", "created_at",
    ),
    "hotels": (
        "hotel_id", "hotel_name", "hotel_tier", "star_rating", "city", "country", "region",
        "latitude", "longitude", "total_rooms", "facilities", "partner_since", "is_active",
    ),
    "payments": (
        "payment_id", "booking_id", "amount", "currency", "payment_method", "payment_status",
        "gateway_code", "processed_at", "refund_amount", "refund_at",
    ),
    "customers": (
        "user_id", "email_hash", "phone_hash", "country", "user_segment", "loyalty_tier",
        "loyalty_points", "first_booking_date", "total_bookings", "is_active", "registered_at",
    ),
    "clickstream": (
        "event_id", "session_id", "user_id", "event_type", "page_url", "hotel_id",
        "search_query", "device_type", "os", "event_timestamp",
    ),
}

# Values put in place of NULL when a staging table is published.
STAGING_DEFAULTS = {
    "bookings": {"user_id": "", "room_type": "", "booking_channel": "Other", "payment_method": ""},
    "hotels": {"hotel_tier": "", "city": "", "country": "", "region": ""},
    "payments": {"currency": "", "payment_method": "", "payment_status": ""},
    "customers": {"country": "", "user_segment": "", "loyalty_tier": ""},
    "clickstream": {"device_type": ""},
}

# Key and version columns by which the latest staging row is found.
STAGING_VERSIONS = {
    "bookings": (("booking_id",), "_batch_date"),
    "hotels": (("hotel_id", "_batch_date"), "_ingested_at"),
    "payments": (("payment_id",), "_batch_date"),
    "customers": (("user_id", "_batch_date"), "_ingested_at"),
    "clickstream": (("event_id",), "_batch_date"),
}

# Attributes whose change opens a new dimension version.
HOTEL_TRACKED = (
    "hotel_name", "hotel_tier", "star_rating", "city", "country", "region", "latitude",
    "longitude", "total_rooms", "facilities", "is_active",
)
CUSTOMER_TRACKED = (
    "email_hash", "country", "user_segment", "loyalty_tier", "first_booking_date", "is_active",
)

# Unknown members, surrogate key 0.
UNKNOWN_HOTEL = {
    "hotel_sk": 0, "hotel_id": "UNKNOWN", "hotel_name": "Unknown hotel",
    "hotel_tier": "unknown", "star_rating": 0, "city": "Unknown", "country": "UNKNOWN",
    "region": "Unknown", "latitude": 0.0, "longitude": 0.0, "total_rooms": 0,
    "facilities": [], "facility_count": 0, "is_active": False,
    "valid_from": MIN_DATE, "valid_to": MAX_DATE, "is_current": True,
}
UNKNOWN_CUSTOMER = {
    "customer_sk": 0, "user_id": "UNKNOWN", "email_hash": "", "country": "UNKNOWN",
    "user_segment": "unknown", "loyalty_tier": "Unknown", "first_booking_date": MIN_DATE,
    "is_active": False, "valid_from": MIN_DATE, "valid_to": MAX_DATE, "is_current": True,
}

# Effective-dated currency rates: (currency, units per USD, valid from).
FX_RATES = (
    ("USD", "1.000000", "2020-01-01"),
    ("VND", "24500.000000", "2020-01-01"),
    ("THB", "35.000000", "2020-01-01"),
    ("SGD", "1.350000", "2020-01-01"),
    ("IDR", "15500.000000", "2020-01-01"),
    ("VND", "25500.000000", "2026-07-01"),
    ("THB", "36.000000", "2026-07-01"),
    ("SGD", "1.340000", "2026-07-01"),
    ("IDR", "16000.000000", "2026-07-01"),
)

# Booking channels: (id, name, type).
CHANNELS = (
    (1, "Web", "direct"),
    (2, "Mobile App", "direct"),
    (3, "Partner API", "partner"),
    (4, "Other", "other"),
)

# Cities: (id, city, country, country code, region, time zone).
GEOGRAPHY = (
    (1, "Ho Chi Minh City", "Vietnam", "VN", "South", "Asia/Ho_Chi_Minh"),
    (2, "Hanoi", "Vietnam", "VN", "North", "Asia/Ho_Chi_Minh"),
    (3, "Da Nang", "Vietnam", "VN", "Central", "Asia/Ho_Chi_Minh"),
    (4, "Nha Trang", "Vietnam", "VN", "Central", "Asia/Ho_Chi_Minh"),
    (5, "Phu Quoc", "Vietnam", "VN", "South", "Asia/Ho_Chi_Minh"),
    (6, "Hue", "Vietnam", "VN", "Central", "Asia/Ho_Chi_Minh"),
    (7, "Bangkok", "Thailand", "TH", "Central", "Asia/Bangkok"),
    (8, "Chiang Mai", "Thailand", "TH", "North", "Asia/Bangkok"),
    (9, "Phuket", "Thailand", "TH", "South", "Asia/Bangkok"),
    (10, "Pattaya", "Thailand", "TH", "Central", "Asia/Bangkok"),
    (11, "Singapore", "Singapore", "SG", "Central", "Asia/Singapore"),
    (12, "Jakarta", "Indonesia", "ID", "Java", "Asia/Jakarta"),
    (13, "Bali", "Indonesia", "ID", "Bali", "Asia/Makassar"),
    (14, "Yogyakarta", "Indonesia", "ID", "Java", "Asia/Jakarta"),
    (15, "Bandung", "Indonesia", "ID", "Java", "Asia/Jakarta"),
)

# Calendar covered by the date dimension.
CALENDAR_START = "2024-01-01"
CALENDAR_DAYS = 1096
