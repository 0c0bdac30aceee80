"""Word lists, host lists and patterns that results depend on. Patterns are case-insensitive."""

# -- fixed values: names ---------------------------------------------------------------------------
# Credentials that are also surnames or words: stripped only when written in capitals or after a comma.
CREDENTIALS_UPPER = (
    "md do ms ma ba bs np pa rn ot msc bsc msn bsn mba mph mha mhs mms msci msce mmsc aprn crnp arnp cnp dnp pac pa-c fnp fnp-bc"
    " pmhnp pmhnp-bc facc facs facp faan faap fasco facog facr fccp fasn fana faes facmg fapa dfapa faanem face facep fache frcp"
    " frcpc frcs mrcp dds dmd edd dpt otr"
).split()
CREDENTIALS_ANY = "phd pharmd mbbs mbchb mbbch drph dphil dsc psyd jr sr ii iii iv".split()
SURNAME_PARTICLES = "van von de del della di da dal la le den der ter ten st mc mac al el bin ibn".split()
MAX_EXTRAS, MAX_ANCHOR_WORDS, MAX_NAME_TOKENS = 2, 6, 15

# -- fixed values: queries -------------------------------------------------------------------------
HONORIFIC = "(MD OR Dr OR PhD)"
CLUSTERS = (
    "",
    '(said OR says OR told OR noted OR "according to")',
    '(presented OR presentation OR conference OR congress OR "annual meeting")',
    '("press release" OR announced OR named OR award OR recognized OR grant)',
    "(study OR trial OR published OR findings OR journal OR research)",
    '("grand rounds" OR CME OR faculty OR speaker OR webinar OR symposium)',
)
CLUSTER_NAMES = ("broad", "quotes", "conference", "press", "publication", "events")
CLUSTER_TERMS = {
    "quotes": ("said", "says", "told", "noted", "according to"),
    "conference": ("presented", "presentation", "conference", "congress", "annual meeting"),
    "press": ("press release", "announced", "named", "award", "recognized", "grant"),
    "publication": ("study", "trial", "published", "findings", "journal", "research"),
    "events": ("grand rounds", "cme", "faculty", "speaker", "webinar", "symposium"),
}
HONORIFIC_TERMS = ("md", "dr", "phd")

# -- fixed values: hosts ---------------------------------------------------------------------------
PLATFORMS = (
    ("facebook.com", "Facebook"),
    ("fb.com", "Facebook"),
    ("instagram.com", "Instagram"),
    ("linkedin.com", "LinkedIn"),
    ("x.com", "X"),
    ("twitter.com", "X"),
    ("youtube.com", "YouTube"),
    ("youtu.be", "YouTube"),
    ("threads.net", "Threads"),
    ("threads.com", "Threads"),
    ("bsky.app", "Bluesky"),
    ("tiktok.com", "TikTok"),
)
TRIAL_HOSTS = "clinicaltrials.gov clinicaltrialsregister.eu euclinicaltrials.eu isrctn.com anzctr.org.au ctri.nic.in umin.ac.jp chictr.org.cn".split()
PUBLISHER_HOSTS = (
    "pubmed.ncbi.nlm.nih.gov ncbi.nlm.nih.gov doi.org nature.com nejm.org thelancet.com sciencedirect.com springer.com link.springer.com"
    " wiley.com onlinelibrary.wiley.com academic.oup.com jamanetwork.com neurology.org bmj.com cell.com frontiersin.org mdpi.com"
    " biorxiv.org medrxiv.org karger.com tandfonline.com sagepub.com journals.lww.com ahajournals.org annualreviews.org plos.org jns.org"
).split()
BLOCKED_HOSTS = (
    "healthgrades.com doximity.com zocdoc.com vitals.com ratemds.com sharecare.com castleconnolly.com npiprofile.com npidb.org npino.com"
    " hipaaspace.com healthcare4ppl.com wellness.com md.com findatopdoc.com caredash.com"
).split()
BLOCKED_PATHS = (("webmd.com", "/doctor"), ("health.usnews.com", "/doctors"))
TRACKING = "utm_source utm_medium utm_campaign utm_term utm_content gclid fbclid ref source".split()

# -- fixed values: patterns of activity ------------------------------------------------------------
TRIAL_TEXT = r"\bnct\d{7,8}\b|clinical ?trials? registry"
PUBLISHER_URL = r"\/doi\/|pubmed|\/pmc\/|\/fulltext|pmid"
SUPPLEMENT_URL = r"supplement|\/abstracts?\/|\.abstract\b"
CONFERENCE_TITLE = r"\b[PS] ?\d+\.[\d.-]+|\bposter\b|\boral presentation\b|\bsession [ivxlc\d]+|platform session|\bplenary\b|\bpresented at\b|\babstract\b"
CONFERENCE_TEXT = r"grand ?rounds|\bcme\b|agenda|registration|register now|accredit|scientific program|call for abstracts|abstract submission|poster session|webinar"
CONFERENCE_URL = r"cme|grand-?rounds|webinar|\/events?\/|\/education\/|\/courses?\/|\/program(me)?\b|\/sessions?\/|learn\.|agenda|abstract[_-]?book|posters?[_-]|session_brochure|\/PDFfiles\/"
PRESS_TEXT = r"press release|announc|\bnews\b|interview|according to|\bsaid\b|\bsays\b|\btold\b|report(s|ed)?\b|award|named|launch|approv|\bfda\b|appoint|recogni[sz]"
PRESS_URL = r"\/news\b|\/article|\/story|\/stories|\/press|\/blog|\/magazine|\/view(article)?\/"
BLOCK_TITLE = (
    "just a moment|attention required|access denied|are you a robot|verify you are human|enable javascript|captcha|pardon our interruption"
    "|request blocked|cloudflare|robot check|security check"
)
SOCIAL_WORDS = "facebook|instagram|youtube|tiktok"
FACEBOOK_PATHS = ("posts", "watch", "photo", "reel", "groups", "p")
EVENT_HORIZON_DAYS = 365

# -- fixed values: page metadata -------------------------------------------------------------------
# (attribute, value) of meta elements, in the order in which they are asked.
TITLE_META = (("property", "og:title"), ("name", "twitter:title"))
DESCRIPTION_META = (("property", "og:description"), ("name", "description"), ("name", "twitter:description"))
AUTHOR_META = (("name", "author"), ("property", "article:author"), ("name", "byl"), ("itemprop", "author"))
DATE_META = (
    ("property", "article:published_time"),
    ("property", "article:published"),
    ("property", "og:published_time"),
    ("name", "date"),
    ("name", "publish-date"),
    ("name", "published-date"),
    ("name", "publication-date"),
    ("name", "article:published_time"),
    ("name", "DC.date"),
    ("name", "dcterms.date"),
    ("itemprop", "datePublished"),
    ("itemprop", "dateCreated"),
    ("property", "datePublished"),
)
DATE_ITEMPROPS = ("datePublished", "dateCreated")
DATE_CLASSES = ("published", "publish-date", "published-date", "publication-date", "post-date", "article-date", "entry-date", "date-published")
BODY_CHARS, PAGE_BYTES = 8000, 5 * 1024 * 1024

# -- fixed values: identity ------------------------------------------------------------------------
AFFILIATION_STOPWORDS = (
    "university hospital medical medicine center centre health healthcare school college institute clinic clinical department division"
    " children childrens national general regional system group associates physicians foundation program cancer"
).split()
DEGREES = "(?:md|phd|mbbs|mbchb|pharmd|dnp|mph|mha|mmsc|msce|frcp|frcpc|facs|facp|faan|faap)"
ROLES = "(?:dr|prof|professor|physician|clinician|surgeon|neurosurgeon|investigator|researcher|scientist|[a-z]{4,}ologist|specialist)"
CLINICAL_PRIMARY = "md do mbbs mbchb dds dmd dvm pharmd dpt od dc psyd dpm np pa-c rn".split()

# -- fixed values: output --------------------------------------------------------------------------
OUTPUT_COLUMNS = (
    ("KOL_ID", "kol_id"),
    ("KOL_Name", "kol_name"),
    ("Search_Query", "search_query"),
    ("Title", "title"),
    ("Description", "description"),
    ("URL", "url"),
    ("Published_Date", "published_date"),
    ("Author", "author"),
    ("Position", "position"),
    ("Source", "source"),
    ("Platform", "platform"),
    ("Activity_Type", "activity_type"),
    ("Validity", "validity"),
    ("Validity_Signals", "validity_signals"),
)
