"""Schemas, domains and dimensions of the catalog."""

from __future__ import annotations

from pyspark.sql import types as T


STRING, BOOLEAN, INTEGER, LONG, TIMESTAMP, STRINGS = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.TimestampType(), T.ArrayType(T.StringType())


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The columns of the six sources.
RIGHTS = _table(
    record_id=STRING, paper_id=STRING, title=STRING, authors_as_listed=STRING, frontiers=STRINGS, topics=STRINGS, source_url=STRING, source_version=STRING,
    source_license=STRING, source_license_url=STRING, permits_adaptation=BOOLEAN, license_decision=STRING, license_checked_at=STRING, translation_status=STRING,
    translation_license=STRING, machine_model=STRING, human_reviewers=STRINGS,
)
CATALOG = _table(record_id=STRING, title=STRING, authors_as_listed=STRING, frontiers=STRINGS, topics=STRINGS, external_url=STRING, number=INTEGER, placement_count=INTEGER)
ANALYSIS = _table(
    record_id=STRING, title=STRING, publication_year=INTEGER, citation_count=STRING, citation_count_without_self_citations=STRING, citations_per_year=STRING,
    impact_proxy_score_0_100=STRING, frontier_labels=STRINGS, primary_arxiv_category=STRING,
)
LENGTHS = _table(record_id=STRING, title=STRING, page_count=STRING, unicode_token_count=STRING)
TITLE = _table(record_id=STRING, title_zh=STRING, status=STRING)
TITLES = T.StructType([T.StructField("machine_model", T.StringType()), T.StructField("translations", T.ArrayType(TITLE))])
TRANSLATIONS = _table(
    record_id=STRING, translation_status=STRING, translation_license=STRING, machine_model=STRING, human_reviewers=STRINGS, publication_translation_url=STRING,
    publication_translation_sha256=STRING, publication_translation_size_bytes=LONG, translation_version=STRING, translation_published_at=STRING,
)

# The columns of the private tables.
PAPERS = _table(
    record_id=STRING, paper_id=STRING, source_url=STRING, source_version=STRING, source_license=STRING, permits_adaptation=BOOLEAN, translation_status=STRING,
    authorization_status=STRING, publication_allowed=BOOLEAN, publication_basis=STRING, created_at=TIMESTAMP, updated_at=TIMESTAMP,
)
CONTACTS = _table(
    contact_id=STRING, record_id=STRING, name=STRING, role=STRING, institution=STRING, email=STRING, source_url=STRING, source_type=STRING, verification_status=STRING,
    verified_at=TIMESTAMP, suppressed_at=TIMESTAMP, notes=STRING, created_at=TIMESTAMP, updated_at=TIMESTAMP,
)
REQUESTS = _table(
    request_id=STRING, record_id=STRING, contact_id=STRING, campaign_id=STRING, request_type=STRING, requested_scope=STRING, requested_license=STRING, status=STRING,
    draft_subject=STRING, draft_body=STRING, approved_by=STRING, approved_at=TIMESTAMP, first_sent_at=TIMESTAMP, last_event_at=TIMESTAMP, follow_up_due_at=TIMESTAMP,
    permission_decision=STRING, permission_scope=STRING, evidence_object_key=STRING, evidence_sha256=STRING, evidence_received_at=TIMESTAMP, created_at=TIMESTAMP,
    updated_at=TIMESTAMP,
)
EVENTS = _table(event_id=STRING, request_id=STRING, event_type=STRING, actor_type=STRING, actor_id=STRING, occurred_at=TIMESTAMP, old_status=STRING, new_status=STRING, metadata=STRING)

# The 38 public columns, in order.
PUBLIC = (
    "paper_id record_id title title_zh title_zh_status title_zh_model authors_as_listed frontiers topics source_url source_version source_license source_license_url permits_adaptation "
    "license_decision translation_status translation_license machine_model human_reviewers authorization_status publication_allowed publication_basis publication_conditions "
    "publication_translation_url publication_translation_sha256 publication_translation_size_bytes translation_version translation_published_at public_updated_at publication_year "
    "citation_count citation_count_without_self_citations citations_per_year impact_proxy_score_0_100 page_count unicode_token_count frontier_labels primary_arxiv_category"
).split()

# Frontiers in official order.
FRONTIERS = {
    "AF": "Accelerator Frontier",
    "CEF": "Community Engagement Frontier",
    "CompF": "Computational Frontier",
    "CF": "Cosmic Frontier",
    "EF": "Energy Frontier",
    "IF": "Instrumentation Frontier",
    "NF": "Neutrinos Frontier",
    "RPF": "Rare Processes & Precision Measurements Frontier",
    "TF": "Theory Frontier",
    "UF": "Underground Facilities & Infrastructure Frontier",
}

# Labels in both languages (Chinese, English).
LABELS = {
    "progress": {
        "AF": ("加速器前沿", "Accelerator Frontier"),
        "CEF": ("社群参与前沿", "Community Engagement Frontier"),
        "CompF": ("计算前沿", "Computational Frontier"),
        "CF": ("宇宙前沿", "Cosmic Frontier"),
        "EF": ("能量前沿", "Energy Frontier"),
        "IF": ("仪器学前沿", "Instrumentation Frontier"),
        "NF": ("中微子前沿", "Neutrinos Frontier"),
        "RPF": ("稀有过程与精密测量前沿", "Rare Processes & Precision Measurements Frontier"),
        "TF": ("理论前沿", "Theory Frontier"),
        "UF": ("地下设施与基础设施前沿", "Underground Facilities & Infrastructure Frontier"),
    },
    "frontier": {
        "AF": ("加速器前沿", "Accelerator Frontier"),
        "CEF": ("社群参与前沿", "Community Engagement Frontier"),
        "CompF": ("计算前沿", "Computational Frontier"),
        "CF": ("宇宙前沿", "Cosmic Frontier"),
        "EF": ("能量前沿", "Energy Frontier"),
        "IF": ("仪器学前沿", "Instrumentation Frontier"),
        "NF": ("中微子前沿", "Neutrino Frontier"),
        "RPF": ("稀有过程与精密测量前沿", "Rare Processes and Precision Measurements Frontier"),
        "TF": ("理论前沿", "Theory Frontier"),
        "UF": ("地下设施与基础设施前沿", "Underground Facilities and Infrastructure Frontier"),
    },
    "authorization": {
        "not-reviewed": ("尚未核验", "Not reviewed"),
        "license-cleared": ("许可证已核验", "License cleared"),
        "needs-permission": ("需要额外授权", "Additional permission needed"),
        "contacted": ("已联系", "Contacted"),
        "response-pending": ("等待回复", "Awaiting response"),
        "permission-granted": ("已获书面授权", "Written permission granted"),
        "permission-denied": ("未获授权", "Permission denied"),
        "unclear": ("回复范围不明确", "Response scope unclear"),
        "withdrawn": ("已撤回", "Withdrawn"),
    },
    "translation": {
        "not-started": ("尚未开始", "Not started"),
        "machine-draft": ("机器初译", "Machine draft"),
        "human-review": ("人工审校", "Human review"),
        "published": ("已公开", "Published"),
        "superseded": ("已被新版替代", "Superseded"),
        "withdrawn": ("已撤回", "Withdrawn"),
    },
    "condition": {
        "attribution": ("保留原作者、题名、来源和许可证署名", "Credit the authors, title, source, and license"),
        "indicate-changes": ("明确标注翻译和后续修改", "Identify the translation and later changes"),
        "share-alike": ("译文采用兼容的相同方式共享许可证", "Use a compatible ShareAlike license"),
        "non-commercial": ("仅限非商业使用", "Non-commercial use only"),
        "written-rightsholder-permission-required": ("发布完整译文前取得权利人的范围明确书面许可", "Obtain clear written rightsholder permission before publishing a full translation"),
        "no-public-adaptation-under-current-source-license": ("当前来源许可证禁止公开演绎作品，需要另行取得权利人许可", "The current source license does not permit public adaptations; separate permission is required"),
        "HAL-distribution-authorization-is-not-adaptation-permission": ("HAL 的分发授权不等于第三方翻译或改编许可", "HAL distribution authorization is not third-party adaptation permission"),
        "verify-current-rightsholder-and-license-before-publication": ("发布前核验当前权利人并取得翻译与公开传播许可", "Verify the current rightsholder and obtain translation and publication permission"),
    },
}

# Domains of states.
TRANSLATION_STAGES = ["not-started", "machine-draft", "human-review", "published"]
TRANSLATION_STATES = [*TRANSLATION_STAGES, "superseded", "withdrawn"]
AUTHORIZATION_STAGES = ["license-cleared", "needs-permission", "contacted", "response-pending", "permission-granted", "permission-denied"]
AUTHORIZATION_STATES = ["not-reviewed", *AUTHORIZATION_STAGES, "unclear", "withdrawn"]
PRIVATE_AUTHORIZATION_STATES = [*AUTHORIZATION_STATES, "license-scope-verified"]
PUBLIC_BASES = ["source-license", "permission-granted", "manual-hold"]
PRIVATE_BASES = [*PUBLIC_BASES, "public-domain", "denied"]
OPEN_BASES = ["source-license", "permission-granted", "public-domain"]
REQUEST_STATES = ["draft", "pending-review", "approved-to-send", "sent", "delivered", "bounced", "replied", "closed", "cancelled"]
APPROVED_STATES = ["approved-to-send", "sent", "delivered", "bounced", "replied", "closed"]
INACTIVE_STATES = ["closed", "cancelled", "bounced"]
DECISIONS = ["unknown", "granted", "granted-with-conditions", "denied", "redirected", "unclear", "no-response"]
CONTACT_ROLES = ["corresponding-author", "collaboration-contact", "rights-holder", "publisher"]
SOURCE_TYPES = ["paper", "author-page", "collaboration-page", "publisher-page"]
VERIFICATIONS = ["unverified", "verified", "stale", "bounced", "suppressed"]
ACTORS = ["human", "agent", "system"]
REQUEST_TYPE = "translation-and-publication"

# Allowed changes of state.
TRANSLATION_EDGES = [("not-started", "machine-draft"), ("machine-draft", "human-review"), ("human-review", "published"), ("published", "superseded"), ("published", "withdrawn")]
AUTHORIZATION_EDGES = [
    ("not-reviewed", "license-cleared"),
    ("not-reviewed", "needs-permission"),
    ("needs-permission", "contacted"),
    ("contacted", "response-pending"),
    ("response-pending", "permission-granted"),
    ("permission-granted", "license-scope-verified"),
    ("response-pending", "permission-denied"),
    ("response-pending", "unclear"),
    *[(s, "withdrawn") for s in PRIVATE_AUTHORIZATION_STATES if s != "withdrawn"],
]

# Licences that allow adaptation, and decisions by licence (None: any other).
ADAPTABLE = ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-SA-4.0", "CC0-1.0"]
LICENSE_DECISIONS = {
    "CC0-1.0": "eligible-after-attribution-check",
    "CC-BY-4.0": "eligible-after-attribution-check",
    "CC-BY-SA-4.0": "eligible-after-sharealike-check",
    "CC-BY-NC-SA-4.0": "eligible-noncommercial-only-after-sharealike-check",
    "HAL-AUTHORIZATION-V1": "hold-hal-authorization-manual-review",
}
NO_DERIVATIVES = "hold-no-public-adaptation"
MANUAL_LICENSE = "hold-manual-license-review"
HOLD_CONDITIONS = {
    "hold-no-public-adaptation": "no-public-adaptation-under-current-source-license",
    "hold-hal-authorization-manual-review": "HAL-distribution-authorization-is-not-adaptation-permission",
    "hold-manual-license-review": "verify-current-rightsholder-and-license-before-publication",
}
DEFAULT_HOLD = "written-rightsholder-permission-required"
#: Licences under which a translation may be published, by the source's licence.
COMPATIBLE = {
    "CC0-1.0": ["CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-SA-4.0"],
    "CC-BY-4.0": ["CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-SA-4.0"],
    "CC-BY-SA-4.0": ["CC-BY-SA-4.0"],
    "CC-BY-NC-SA-4.0": ["CC-BY-NC-SA-4.0"],
}

# Families of arXiv categories; any other category is its own family.
FAMILIES = {
    "hep-ph": "Particle phenomenology",
    "hep-ex": "Experimental particle physics",
    "physics.acc-ph": "Accelerator science",
    "physics.ins-det": "Instrumentation and detectors",
    "hep-th": "Formal theory / quantum gravity",
    "astro-ph.CO": "Cosmology",
    "physics.ed-ph": "Physics and instrumentation",
    "physics.soc-ph": "Community, education and society",
    "hep-lat": "Lattice gauge theory",
    "quant-ph": "Quantum information and sensors",
    "gr-qc": "Gravitation and cosmology",
    "physics.data-an": "Data analysis",
    "astro-ph.HE": "High-energy astrophysics",
    "nucl-ex": "Experimental nuclear physics",
    "physics.comp-ph": "Computational physics",
    "astro-ph.IM": "Astrophysical instrumentation",
    "physics.med-ph": "Physics and instrumentation",
    "physics.plasm-ph": "Physics and instrumentation",
}

# Chinese names of families; any other is unclassified.
FAMILIES_ZH = {
    "Particle phenomenology": "粒子唯象学",
    "Experimental particle physics": "实验粒子物理",
    "Accelerator science": "加速器科学",
    "Instrumentation and detectors": "仪器与探测器",
    "Formal theory / quantum gravity": "形式理论与量子引力",
    "Cosmology": "宇宙学",
    "Physics and instrumentation": "物理与仪器",
    "Community, education and society": "社群、教育与社会",
    "Lattice gauge theory": "格点规范理论",
    "Quantum information and sensors": "量子信息与量子传感器",
    "Gravitation and cosmology": "引力与宇宙学",
    "Data analysis": "数据分析",
    "High-energy astrophysics": "高能天体物理",
    "Experimental nuclear physics": "实验核物理",
    "Computational physics": "计算物理",
    "Astrophysical instrumentation": "天体物理仪器",
}
UNCLASSIFIED_ZH = "未分类"

# Badge classes of states.
BADGES = {
    "badge-cleared": ["license-cleared", "permission-granted", "published"],
    "badge-pending": ["needs-permission", "contacted", "response-pending", "unclear", "machine-draft", "human-review"],
    "badge-blocked": ["permission-denied", "withdrawn"],
}

# The tree audit.
MAX_FILE_BYTES = 50 * 1024 * 1024
FORBIDDEN_PREFIXES = ["tmp/"]  # a catalog adds the prefixes of its own source and cache folders
PRIVATE_PREFIX = "private/"
PRIVATE_ALLOWED = ["private/.gitignore", "private/README.md", "private/schema.sql"]
PATTERNS = {
    "email address": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "API token": r"(?:sk|rk|ghp|github_pat)-[A-Za-z0-9_\-]{12,}",
    "private key": r"BEGIN (?:RSA|OPENSSH|EC|PGP) PRIVATE KEY",
}
