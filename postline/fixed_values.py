"""Names, patterns and formats that existing data and tables use."""

# Text rules (Java regular expressions).
NON_LETTER = r"[^a-zA-Z\s]"
LEADING_HANDLE = r"^@\w+"
URL = r"http\S+"

# Date formats.
DAY_FORMAT = "yyyy-MM-dd"
DAY_LENGTH = 10
TIME_FORMAT = "HH:mm:ss"
CREATION_FORMAT = "yyyy-MM-dd HH:mm:ss+00:00"

# Posts kept per account and run, unless the run asks for another number.
TIMELINE_LENGTH = 50

# Rows shown by a table preview.
PREVIEW_ROWS = 10

# Landing files: zone folder, table names, separator.
LANDING_ZONE = "raw_data"
PROCESSED_ZONE = "processed_data"
POSTS = "TWEET_INFO"
ACCOUNTS = "USER_INFO"
ACTIVITY = "USER_ACTIVITY"
SEPARATOR = "|"
QUOTE = '"'
LANDING_GLOB = "*.csv"

# Warehouse tables.
POSTS_TABLE = "tweets"
ACCOUNTS_TABLE = "users"

# Compression of Parquet files, whatever the session says.
CODEC = "zstd"
