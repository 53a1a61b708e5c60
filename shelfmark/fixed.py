"""Fixed values that outputs have to match exactly."""

# Names of taxonomy levels 1 to 6.
LEVEL_NAMES = ["Segment", "Family", "Class", "Brick", "Attribute", "AttributeValue"]

# The source tag of a taxonomy node and the joiners of its text.
NODE_SOURCE = "gs1_gpc"
PATH_JOINER = " > "
PART_JOINER = " | "
EXCLUDES_PREFIX = "Excludes: "

# Default column names and sizes of the three jobs.
LOOKUP_FIELDS = ["level", "code", "title", "hierarchy_path", "hierarchy_string"]
ROW_TEXT_SEPARATOR = " * "
PROMPT_COLUMNS = [
    "store", "country", "product_name", "product_name_en",
    "packaging_type", "packaging_value", "packaging_unit",
]
TARGET_COLUMNS = [
    "gs1_segment", "gs1_family", "gs1_class", "gs1_brick",
    "gs1_attribute", "gs1_attribute_value",
]
VECTOR_COLUMN = "embedding_context"
TOP_K = 30
PROMPT_ROWS = 10
EMBED_CALL_ROWS = 256
BRICK_DEPTH = 4

# Display labels are shortened by these replacements, in order.
LABEL_SHORT_FORMS = [
    ("Prepared/Processed", "Prep."),
    ("Beverages - Non-Alcoholic", "Non-Alc. Bev."),
    ("Beverages - Alcoholic", "Alc. Bev."),
    ("Health & Beauty", "H&B"),
    ("Household & Office", "HH&O"),
]
TOP_CATEGORIES = 4

# The error text of a response that holds no answer list.
UNPARSEABLE = "Could not parse LLM response after JSON and regex attempts"

# Prompt texts.
SYSTEM_PROMPT = """\
You are a product classification assistant. Your job is to classify grocery and retail products using the GS1 GPC (Global Product Classification) standard.

For each product, you will receive:
- Product information (name, packaging, category hints, etc.). Product names may be in German or other languages — use the English name (product_name_en) when available, otherwise interpret the local-language name to determine the product type.
- A list of candidate GS1 categories found by similarity search, labeled with letters [A], [B], [C], etc.

Choose the single best matching category for each product by selecting its letter. Always make a selection — pick the closest match even if it is not perfect. Never skip a product.

Respond with a JSON object containing a "results" key with an array of objects:
{"results": [{"product_id": <id>, "choice": "<letter>"}]}

Be precise. Choose the most specific matching category."""

USER_PROMPT_HEAD = "Classify the following {n} product(s) into GS1 GPC categories.\n\n"
USER_PROMPT_TAIL = (
    '\nRespond with a JSON object containing a "results" key:\n'
    '{"results": [{"product_id": <id>, "choice": "<letter>"}, ...]}'
)

PLAIN_SYSTEM_PROMPT = (
    "You are a product classification assistant. Classify grocery/retail products "
    "using the GS1 GPC standard. Respond with JSON: "
    '{"results": [{"product_id": <id>, "choice": "<letter>"}]}'
)
PLAIN_PROMPT_HEAD = "Classify these products into GS1 GPC categories.\n\n"
PLAIN_PROMPT_TAIL = 'Respond with: {"results": [{"product_id": <id>, "choice": "<letter>"}]}'
