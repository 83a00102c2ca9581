"""Input and message schemas, as DDL text that every Spark reader accepts."""

# Column names and types of the input files and messages.
VIDEOS_CSV = """
    video_id string, title string, description string, channel_title string,
    category_id string, tags string, trending_date string,
    views string, likes string, dislikes string
"""

CATEGORIES_JSON = """
    kind string, etag string,
    items array<struct<
        kind: string, etag: string, id: string,
        snippet: struct<channelId: string, title: string, assignable: boolean>>>
"""

TRANSACTIONS_CSV = """
    step int, type string, amount double,
    nameOrig string, oldbalanceOrg double, newbalanceOrig double,
    nameDest string, oldbalanceDest double, newbalanceDest double,
    isFraud int not null, isFlaggedFraud int not null
"""

TWEETS_CSV = """
    tweet_id string, author_id string, inbound string, created_at string,
    text string, response_tweet_id string, in_response_to_tweet_id string
"""

MESSAGE = "tweet_id string, created_at string, text string"

MINUTE_FILE = "tweet_id string, created_at string, text string"
