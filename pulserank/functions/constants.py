"""Fixed values.

These words, weights and thresholds define the results, so they are stated plainly
here and passed as default arguments.  Vocabularies that are larger than a screen
(topic keywords, the English stop list) are always arguments.
"""

# Characters that Python's str.strip() / str.split() treat as white space.
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
BLANKS = (
    " \t\x1f\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)
WHITESPACE = BLANKS + LINE_BREAKS

# Column aliases: alternative name -> canonical name.
RAW_ALIASES = {
    "created_at": "created_utc",
    "created_at_utc": "created_utc",
    "comments": "num_comments",
    "comment_count": "num_comments",
    "upvotes": "score",
    "points": "score",
}
CANDIDATE_ALIASES = {
    "description": "text",
    "body": "text",
    "engagement": "score",
    "upvotes": "score",
    "points": "score",
    "comments": "num_comments",
    "comment_count": "num_comments",
    "created_at": "created_utc",
    "created_at_utc": "created_utc",
}

RAW_COLUMNS = (
    "id", "source", "title", "text", "url", "score", "num_comments", "created_utc", "domain",
)
SNAPSHOT_COLUMNS = RAW_COLUMNS + (
    "domain_category", "topic_category", "title_length", "age_days", "engagement_score",
    "snapshot_utc",
)

# Domain -> category; the order decides which suffix wins.
DOMAIN_CATEGORIES = {
    "github.com": "developer_tools",
    "gitlab.com": "developer_tools",
    "openai.com": "artificial_intelligence",
    "anthropic.com": "artificial_intelligence",
    "deepmind.google": "artificial_intelligence",
    "huggingface.co": "machine_learning",
    "arxiv.org": "research",
    "paperswithcode.com": "research",
    "aws.amazon.com": "cloud_computing",
    "azure.microsoft.com": "cloud_computing",
    "cloud.google.com": "cloud_computing",
    "kubernetes.io": "devops",
    "docker.com": "devops",
    "postgresql.org": "databases",
    "sqlite.org": "databases",
    "mongodb.com": "databases",
    "react.dev": "frontend_development",
    "nodejs.org": "backend_development",
}

# Labels that carry no information when a domain label is chosen.
EMPTY_LABELS = ("unknown", "other", "nan", "none")
EMPTY_LABELS_FOR_EMBEDDING = ("unknown", "other", "nan")

# Score weights.
SCORE_WEIGHTS = {
    "similarity": 0.45,
    "engagement_score": 0.20,
    "freshness_score": 0.15,
    "trend_score": 0.10,
    "effort_score": 0.10,
}
TWO_SIGNAL_WEIGHTS = {"similarity": 0.6, "engagement_score": 0.4}
KEYWORD_WEIGHTS = {"match": 0.55, "quality": 0.25, "freshness": 0.10, "effort": 0.10}
PROXY_WEIGHTS = {"similarity": 0.5, "engagement": 0.3, "comments": 0.2}
LABEL_WEIGHTS = {"strength": 0.65, "similarity": 0.35}

EFFORT_SCORES = {"low": 1.0, "medium": 0.6, "high": 0.3}
EFFORT_WORDS = {"medium": 100, "high": 300}
MISSING_AGE_DAYS = 365

BEGINNER_DOMAINS = ("beginner", "beginner_coding", "beginner coding", "learn", "learning")
BEGINNER_PHRASES = (
    "good first issue", "good-first-issue", "beginner", "starter", "first issue",
)
FIRST_ISSUE_PHRASES = (
    "good first issue", "good-first-issue", "beginner", "starter", "first-issue",
)

# Explanation thresholds.
REASON_THRESHOLDS = {
    "similarity": 0.85,
    "engagement_score": 0.75,
    "freshness_score": 0.75,
    "trend_score": 0.70,
    "effort_score": 0.75,
}

# Interaction grades.
RELEVANCE = {"engaged": 3, "bookmarked": 2, "clicked": 1, "skipped": 0}
PERCENTILE_GRADES = (("engaged", 0.90), ("bookmarked", 0.70), ("clicked", 0.40))
QUANTILE_GRADES = ((3, 0.95), (2, 0.85), (1, 0.70))

VARIANT_NAMES = {
    "similarity_only": "Similarity Only",
    "similarity_engagement": "Similarity + Engagement",
    "full_scoring": "Full Scoring Model",
    "full_with_diversity": "Full Model + Diversity Re-ranking",
}

# Feedback: action -> (weight of the user vector, weight of the item vector).
FEEDBACK_WEIGHTS = {
    "engage": (0.90, 0.10),
    "bookmark": (0.93, 0.07),
    "skip": (0.95, -0.05),
}

# Stop words of the analytics job and of the keyword ranker.
ANALYTICS_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "how", "in", "is", "it",
    "new", "of", "on", "or", "show", "the", "to", "with", "you", "your",
)
RANKER_STOP_WORDS = ("and", "are", "for", "from", "into", "the", "this", "with", "your")

# Preference key -> other spellings.
PREFERENCE_ALIASES = {
    "artificial_intelligence": ("ai", "artificial intelligence", "llm", "openai"),
    "devops": ("devops", "kubernetes", "k8s", "cloud native", "terraform"),
    "machine_learning": ("machine learning", "ml", "deep learning", "rag"),
    "frontend_development": ("frontend", "react", "typescript", "css", "web"),
    "developer_tools": ("developer tools", "ide", "cli", "tooling"),
    "cloud_computing": ("cloud", "aws", "azure", "gcp"),
}

# Profile fields that hold terms, in reading order.
PROFILE_FIELDS = (
    "interests", "technical_skills", "skills", "expertise", "preferred_domains", "domains",
    "topics_of_expertise", "expertise_topics", "topics",
)
HISTORY_FIELDS = ("title", "domain", "topic", "topic_category", "source")

# Archive events.
ARCHIVE_EVENT_TYPES = (
    "PushEvent", "IssuesEvent", "PullRequestEvent", "IssueCommentEvent",
    "PullRequestReviewCommentEvent", "PullRequestReviewEvent", "CommitCommentEvent",
    "ReleaseEvent", "CreateEvent", "ForkEvent", "WatchEvent", "PublicEvent", "GollumEvent",
)
DELETED_MARKERS = ("[deleted]", "[removed]", "[bot]", "")
DELETED_HIT_MARKERS = ("[deleted]", "[dead]", "")
PAYLOAD_SKIPPED_KEYS = ("avatar_url", "gravatar_id", "sha", "id", "node_id")
ITEM_PAGE = "https://news.ycombinator.com/item?id="

COVERAGE_UNKNOWN_WARN = 0.50
COVERAGE_MINIMUM = 0.05
