"""Results depend on every one of them, so they stand here as plain text."""

# Snapshot files
SNAPSHOT_DATE_FORMAT = "yy.dd.MM"
TAG_QUOTE = '"'
TAG_SEPARATOR = "|"

# Analyses
TOP_VIDEOS = 10
WEEK_MIN_APPEARANCES = 2
PERIOD_DAYS = 30
TOP_TAGS = 10
TOP_CHANNELS = 20
TOP_TRENDING_CHANNELS = 10
MIN_VIEWS = 100000
TOP_CATEGORY_VIDEOS = 10

# Messages
TOPIC = "tweets"
SECONDS_BETWEEN_MESSAGES = 0.09
MESSAGE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_KEY_SUFFIX = "_00"
