"""Word lists, scores and limits that the results depend on, in natural order."""

# fixed values: page regions
HEADER_CLASSES = """header site-header page-header main-header top-header global-header fixed-header sticky-header l-header c-header
site_header page_header main_header top_header global_header masthead site-head page-head""".split()
NOT_HEADER_PREFIXES = """section card panel article content widget box block modal table list grid accordion tab column sidebar form field
group item entry comment post slide media dropdown popup drawer overlay dialog step module hero banner ehf""".split()
HEADER_IDS = "header site-header page-header main-header masthead site_header page_header main_header".split()
NAV_CLASSES = """navbar navigation nav-bar main-nav site-nav primary-nav top-nav global-nav main-navigation site-navigation primary-navigation
nav-menu main_nav site_nav primary_nav top_nav""".split()
NAV_IDS = "nav navbar navigation main-nav site-nav main_nav site_nav primary-nav".split()
LOGO_WIDGETS = "elementor-widget-theme-site-logo elementor-widget-site-logo wp-block-site-logo custom-logo-link site-logo site-branding".split()

# fixed values: addresses of images
LIKELY_LOGO = "logo brand header-img site-icon company".split()
REJECT_FILENAME = """spacer pixel tracking 1x1 blank. spinner loading placeholder cart basket search hamburger account login user-icon phone
envelope email-icon close cross chevron arrow caret toggle wishlist heart share print""".split()
REJECT_ADDRESS = """profile-photo profile-pic profile-image avatar/ avatar. user-avatar /wallpaper bg-pattern bg-texture /flags/ /flags. flag-icon
flag_icon /country-flag /country_flag flagcdn.com flagpedia countryflags wp-includes/images/media/default wp-includes/images/w-logo
wp-includes/images/blank.gif /g-placeholder""".split()
THIRD_PARTY = """cookielaw.org cookiebot.com onetrust.com cookie-cdn cookie-script trustarc evidon.com quantcast termly.io powered_by_logo gdpr
consent-manager captcha-delivery.com /captcha/ datadome.co hcaptcha.com recaptcha facebook.com/tr analytics. pixel. beacon.
gstatic.com/images/branding google.com/images/branding translate.google""".split()
EXTENSIONS = ".svg .png .jpg .jpeg .gif .webp .ico .bmp".split()
LAZY_PREFIXES = ["data:image/gif;base64,", "data:image/png;base64,iVBOR", "data:image/svg+xml,%3Csvg", "about:blank"]
LAZY_ATTRIBUTES = ["data-src", "data-lazy-src", "data-original", "data-lazy"]
FRAMEWORK_ICONS = "jhipster angular_logo react-logo vue-logo next-logo nuxt-icon vite. webpack-logo".split()
DEALER_ADDRESS = "dealer-logo dealer_logo /dealer/ dealer-logos dealer_logos haendler franchise filiale".split()
DEALER_ADDRESS_RENDERED = DEALER_ADDRESS[:7]
PLATFORMS = """instagram youtube linkedin tiktok pinterest telegram whatsapp snapchat vimeo flickr tumblr reddit amazon-logo amazon_logo paypal-logo
paypal_logo google-logo google_logo""".split()
META_BRANDS = [*PLATFORMS, "facebook", "twitter", "social"]
META_SCORES = {"og:image": 45, "og:logo": 70, "twitter:image": 40, "msapplication-tileimage": 35, "image": 30}

# fixed values: scoring of images
NAV_LOGO = """nav_logo nav-logo navbar-logo navbar_logo eut_nav_logo main-logo main_logo site-logo site_logo top-logo top_logo site-header__logo
header__logo header-logo header_logo masthead-logo masthead__logo branding__logo branding-logo navigation-logo navigation_logo home-logolink
home-logo home_logo logolink""".split()
DEALER_WORDS = "dealer franchise branch filiale autohaus haendler händler standort".split()
PARTNER_WORDS = "partner sponsor client customer affiliate certification award badge trust seal payment association".split()
UI_WORDS = "cart basket search hamburger account login phone envelope wishlist heart share print cross toggle eicon".split()
CAREER_LINKS = "/karriere- /career- /partner/ /client/".split()
OTHER_LOGO_PATHS = "/logos/ /partner /client /sponsor /certification /award".split()
CONTENT_DIRS = "/media/ /uploads/ /files/ /styles/ /public/ /active_storage/ /wp-content/uploads/ /sites/ /push_menu/ /promo/".split()
ICON_HINTS = [*"""icon toggle menu chevron arrow spinner loading caret close cart basket search hamburger account user login phone envelope email
wishlist heart share print cross plus minus eicon fa-""".split(), "fas ", "far ", "fab "]
ICON_HINTS_RENDERED = [h for h in ICON_HINTS if h != "loading"]

# fixed values: scoring of rendered images
RENDERED_REJECT = """cookielaw.org cookiebot.com onetrust.com cookie-cdn cookie-script trustarc evidon.com quantcast termly.io powered_by_logo gdpr
consent-manager gstatic.com/images/branding google.com/images/branding googlelogo google-logo translate.google recaptcha.net facebook.com/tr
analytics. pixel. beacon. captcha-delivery.com /captcha/ datadome.co hcaptcha.com /flags/ /flags. flag-icon flag_icon flagcdn.com countryflags
country-flag country_flag flagpedia wp-includes/images/media/default wp-includes/images/w-logo wp-includes/images/blank.gif
/g-placeholder""".split()
RENDERED_UI = [*"""cart basket search hamburger account user-icon login phone envelope email-icon wishlist heart share print close cross toggle eicon
fa-""".split(), "fas ", "far ", "fab "]

# fixed values: challenge pages
CAPTCHA_TITLES = ["captcha", "security check", "challenge", "just a moment", "attention required", "ddos-guard", "access denied", "bot verification"]
CAPTCHA_BODY = ["captcha-delivery.com", "datadome"]
CAPTCHA_CHARS = 5000

# fixed values: vector images
WHITE_FILLS = ["#fff", "#ffffff", "white", "rgb(255,255,255)"]
BLACK = "#000000"
WHITE_SPELLINGS = ["#fff", "#ffffff", "#FFF", "#FFFFFF", "white"]
LEAST_VIEWBOX = 20
LEAST_SVG_CHARS = 200

# fixed values: schemes whose relative addresses are merged with their base
MERGED_SCHEMES = ["", "http", "https", "ftp", "file", "ws", "wss"]

# fixed values: files
LEAST_BYTES, LEAST_LOGO_BYTES, LEAST_DATA_URI_BYTES, MOST_BYTES = 200, 500, 400, 250_000
MOST_WIDTH, MOST_HEIGHT = 800, 400
WEAK_BYTES = 2000
WEAK_IF_SMALL = "google_favicon duckduckgo_icon favicon_direct link_tag".split()
WEAK_ALWAYS = "meta_tag css_background".split()
SPARES = 6
CONTENT_TYPES = {"svg": ".svg", "png": ".png", "jpeg": ".jpg", "jpg": ".jpg", "gif": ".gif", "webp": ".webp", "x-icon": ".ico", "ico": ".ico"}
CONTENT_TYPES_CURL = {k: v for k, v in CONTENT_TYPES.items() if k in ("svg", "png", "jpeg", "gif", "webp")}
CONTENT_TYPES_ICON = {"png": ".png", "ico": ".ico", "svg": ".svg", "jpeg": ".jpg", "jpg": ".jpg"}
CONTENT_TYPES_BROWSER = {"svg": ".svg", "jpeg": ".jpg", "jpg": ".jpg", "webp": ".webp", "gif": ".gif", "ico": ".ico"}
CONTENT_TYPES_OF = {"http": CONTENT_TYPES, "curl": CONTENT_TYPES_CURL, "icon": CONTENT_TYPES_ICON, "browser": CONTENT_TYPES_BROWSER}
CONTENT_DEFAULT = {"icon": ".png", "browser": ".png"}
BROWSER_LEAST_SVG = 100

# fixed values: order of the sources of candidates, and scores of those that are not pages
STRATEGY_ORDER = """json_ld link_tag meta_tag img_tag svg_fallback css_background manifest favicon_direct wp_json_logo wp_json_icon clearbit
google_favicon duckduckgo_icon""".split()
SOURCE_SCORES = {"favicon_direct": 30, "wp_json_logo": 90, "wp_json_icon": 60, "clearbit": 85, "google_favicon": 25, "duckduckgo_icon": 20}

# fixed values: fetching
FETCH_STATUSES = [403, 404, 406, 451, 503]
FETCH_LEAST_CHARS, FETCH_HEAD = 2000, 200
FETCH_ATTEMPTS, FETCH_SCHEMES = 3, ["https", "http"]
USER_AGENTS = 3

# fixed values: image hashes
GATE = (10, 12, 10)
HASH_SIDE, NORM_SIDE, CROP_LEAST, CROP_THRESHOLD, LEAST_SIDE, LEAST_CONTRAST, GREY = 8, 128, 16, 25, 8, 20, 128
SIZE_BUCKETS = [(1, 1, "1"), (2, 5, "2-5"), (6, 10, "6-10"), (11, 25, "11-25"), (26, 50, "26-50"), (51, 100, "51-100"), (101, None, "100+")]
