"""Fixed values.

Everything in this module is data that has to be exactly so for results to be
right: sentinels, column headers, metric labels, page markers, link formats and
text patterns. There is no logic here.
"""

# Missing-value sentinel and the texts that count as missing.
NA = "N/A"
MISSING_TEXTS = ("", "N/A", "nan")
PLACEHOLDER_TEXTS = ("", "-", "N/A")

# Snapshot label "<start> ~ <end>", dates as yyyy-MM-dd.
SNAPSHOT_SEPARATOR = " ~ "
DAY_FORMAT = "yyyy-M-d"
LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Public addresses of a video and of a livestream room.
#   https://www.tiktok.com/@<creator>/video/<id>
#   https://www.tiktok.com/@<creator>/live?room_id=<id>
PROFILE_BASE = "https://www.tiktok.com/@"
VIDEO_PART = "/video/"
LIVE_PART = "/live?room_id="
LIVE_PATH = "/livestream/detail"
ID_PARAM = "id"

# Text patterns.
REVIEWS_PATTERN = r"Reviews:\s*(\d+)"
SKUS_PATTERN = r"\((\d+)\)"
AD_DAYS_PATTERN = r"(?i)(\d+)\s*Days"
FOLLOWERS_PATTERN = r"(?i)Followers\s*([\d,.]+[kKmM]?)"
NUMBER_PATTERN = r"([\d,.]+[kKmM]?)"
FOLLOWERS_WORD = "Followers"
MARKER = ": "

# Metric labels as pages show them.
SHOP_LABELS = [
    "Revenue",
    "Self-Operated Account Revenue",
    "Affiliate Revenue",
    "Shopping Mall Revenue",
    "Item Sold",
    "Avg. Unit Price",
    "Active Affiliates",
    "New Videos By Affiliate",
]
PRODUCT_LABELS = [
    "Revenue",
    "Item Sold",
    "Avg. Unit Price",
    "Live Revenue",
    "Video Revenue",
    "Product Card",
    "Creator Conversion Ratio",
    "Concentration Rate (L30D)",
]
LIVE_LABELS = ["Avg. Online Viewer", "Views", "Item Sold", "Avg. Unit Price"]
VIDEO_LABELS = [
    "Views",
    "Sales",
    "New Followers",
    "Ad View Ratio",
    "Ad Revenue Ratio",
    "Ad Spend",
    "Ad ROAS",
]
AUDIENCE_TEXTS = ("Majority", "Gender Balance")

# Column headers of the tables, in order; the load time is added on write.
TABLE_HEADERS = {
    "shop_metrics": [
        "Shop Link",
        "Shop_Revenue",
        "Shop_Self-Operated Account Revenue",
        "Shop_Affiliate Revenue",
        "Shop_Shopping Mall Revenue",
        "Shop_Item Sold",
        "Shop_Avg. Unit Price",
        "Shop_Active Affiliates",
        "Shop_New Videos By Affiliate",
        "Date Filter",
    ],
    "shop_creators": [
        "Shop Link",
        "Creator Name",
        "Account Type",
        "TikTok Link",
        "MCN",
        "Debut Time",
        "Creator Bio",
        "Target Sexual",
        "Target Age",
        "Followers",
        "Date Filter",
    ],
    "product_metrics": [
        "Shop Link",
        "Product Name",
        "TikTok Product Link",
        "Rating",
        "Number of Reviews",
        "Product SKUs",
        "Product_Revenue",
        "Product_Item Sold",
        "Product_Avg. Unit Price",
        "Product_Live Revenue",
        "Product_Video Revenue",
        "Product_Product Card",
        "Product_Creator Conversion Ratio",
        "Product_Concentration Rate (L30D)",
        "Date Filter",
    ],
    "product_creators": [
        "Shop Link",
        "Product Name",
        "Product Link",
        "Creator Name",
        "TikTok Link",
        "MCN",
        "Debut Time",
        "Creator Bio",
        "Target Sexual",
        "Target Age",
        "Followers",
        "Date Filter",
    ],
    "videos": [
        "Shop Link",
        "Product Name",
        "Product Link",
        "Creator Name",
        "Creator Link",
        "Link",
        "Type",
        "Revenue",
        "Item Title",
        "Video Duration",
        "Publish Date",
        "Advertising Period (Days)",
        "Views",
        "Item Sold",
        "New Followers Generated",
        "Ad View Ratio",
        "Ad Revenue Ratio",
        "Ads Spending",
        "Ad ROAS",
        "Date Filter",
    ],
    "lives": [
        "Shop Link",
        "Product Name",
        "Product Link",
        "Creator Name",
        "Creator Link",
        "Revenue",
        "Link",
        "Item Title",
        "Livestream Time",
        "Duration",
        "Avg Online Viewer",
        "Views",
        "Item Sold",
        "Avg Unit Price",
        "Date Filter",
    ],
    "product_dim": ["Shop Link", "Product Name", "Product Link"],
}

# Name of each table's sheet.
SHEET_NAMES = {
    "shop_metrics": "Shop_Metrics",
    "shop_creators": "creator_dim_shop",
    "product_metrics": "Product_Metrics",
    "product_creators": "Creators",
    "videos": "Videos",
    "lives": "Lives",
    "product_dim": "product_Dim",
}

# Page markers: where landed markup keeps each field. Class names and texts are
# looked for as parts of the class attribute and of the text.
#   tag, cls      the element; ``own`` / ``text``: one of these occurs in its own
#                 / whole text; ``attr``: read this attribute, ``has`` is part of it
#   within        class parts of an ancestor; ``within_text``: part of its text
#   inside        (tag, class part, n): an element that is the n-th such child of its
#                 parent holds or is it; ``child``: it is a child of that element
#   after         (class part, text): it is the first such element past this label
#   sibling       (class part, text): it is the next one beside this label;
#                 ``beside``: or an earlier one with this class part
#   part          class part of the descendant that is read instead
CREATOR_RULES = [
    {"field": "tiktok_link", "tag": "a", "attr": "href", "has": "tiktok.com/@"},
    {"field": "mcn", "tag": "div", "cls": ["text-base-666"], "within": ["mcn"]},
    {"field": "debut_text", "tag": "div", "cls": ["text-base-666"], "text": ["Debut Time : "]},
    {"field": "bio", "tag": "div", "sibling": ("", "Creator Bio:"), "beside": "flex-1"},
    {"field": "target_sexual", "tag": "span", "own": ["Majority", "Gender Balance"]},
    {"field": "target_age", "tag": "span", "own": ["-"], "within": ["flex", "gap-[4px]"]},
]
SHOP_CREATOR_RULES = [
    *CREATOR_RULES,
    {
        "field": "bio_fallback",
        "tag": "div",
        "cls": ["flex-1", "text-base-666"],
        "within": ["flex", "items-center", "gap-[2px]"],
    },
    {"field": "followers_text", "tag": "div", "cls": ["table-row"], "text": ["Followers"]},
]
PRODUCT_CREATOR_RULES = [
    *CREATOR_RULES,
    {
        "field": "bio_fallback",
        "tag": "div",
        "cls": ["flex-1", "text-base-666"],
        "within": ["flex", "items-center"],
    },
    {
        "field": "followers_text",
        "tag": "div",
        "own": ["k", "m"],
        "within": ["table-row"],
        "within_text": "Followers",
    },
]
PRODUCT_RULES = [
    {"field": "product_link", "tag": "a", "text": ["View on TikTok"], "attr": "href"},
    {"field": "rating_text", "tag": "span", "text": ["/5"]},
    {"field": "reviews_text", "tag": "span", "text": ["Reviews:"]},
    {"field": "skus_text", "tag": "div", "cls": ["product-sku"]},
]
VIDEO_RULES = [
    {"field": "creator", "tag": "div", "cls": ["text-ellipsis1", "font-medium"]},
    {"field": "publish_date", "tag": "div", "sibling": ("text-base-999", "Publish Date")},
    {"field": "video_duration", "tag": "div", "sibling": ("text-base-999", "Duration")},
    {"field": "ad_period", "tag": "div", "cls": ["info"], "own": ["Days"]},
    {"field": "views", "tag": "div", "cls": ["value"], "after": ("labelViews", ""), "part": "block"},
    {"field": "item_sold", "tag": "div", "cls": ["value"], "after": ("labelSales", ""), "part": "block"},
    {
        "field": "new_followers_generated",
        "tag": "div",
        "cls": ["value"],
        "after": ("labelNew Followers", ""),
        "part": "block",
    },
    {
        "field": "ad_view_ratio",
        "tag": "div",
        "cls": ["value"],
        "after": ("labelAd View Ratio", ""),
        "part": "block",
    },
    {
        "field": "ad_revenue_ratio",
        "tag": "div",
        "cls": ["value"],
        "after": ("labelAd Revenue Ratio", ""),
        "part": "block",
    },
    {
        "field": "ads_spending",
        "tag": "div",
        "cls": ["value"],
        "after": ("labelAd Spend", ""),
        "part": "block",
    },
    {"field": "ad_roas", "tag": "div", "cls": ["value"], "after": ("labelAd ROAS", ""), "part": "block"},
]
LIVE_RULES = [
    {"field": "creator", "tag": "div", "cls": ["text-ellipsis1", "font-medium", "mb-1"]},
    {"field": "livestream_time", "tag": "span", "inside": ("div", "table-row", 2), "child": True},
    {
        "field": "duration",
        "tag": "div",
        "cls": ["table-cell"],
        "inside": ("div", "table-row", 2),
        "child": True,
    },
]
ROW_RULES = {
    "shop_creator": [
        {"field": "name", "tag": "div", "cls": ["line-clamp-1"], "inside": ("td", "", 2)},
        {"field": "account_type", "tag": "td", "inside": ("td", "", 3)},
    ],
    "product": [
        {"field": "name", "tag": "div", "cls": ["line-clamp-2"], "inside": ("td", "", 2)},
    ],
    "creator": [
        {"field": "name", "tag": "div", "cls": ["line-clamp-1"], "inside": ("td", "", 2)},
    ],
    "video": [
        {"field": "name", "tag": "span", "cls": ["line-clamp-2"], "inside": ("td", "", 2)},
        {"field": "revenue", "tag": "td", "inside": ("td", "", 3)},
        {"field": "ad_mark", "tag": "g", "attr": "id", "has": "AD"},
    ],
    "live": [
        {"field": "name", "tag": "div", "cls": ["line-clamp-2"]},
        {"field": "revenue", "tag": "td", "inside": ("td", "", 4)},
    ],
}
# Metric tiles: class parts of the container, the tile, its label and its value.
METRICS_CONTAINER = "Layout-CoreMetrics"
METRIC_TILE = "item"
METRIC_LABEL = ("label", "line-clamp-2")
METRIC_VALUE = "value"
