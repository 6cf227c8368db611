"""Rule tables of the analysis.

Fixed values: labels, keywords and patterns in this file must equal those the
results are compared with. They are data: every function that uses them takes
other rules as an argument. The skill dictionary is not here; it is an input
table (see `sources.read_dictionary`).
"""

# --- work mode, on folded text: both, the first kind, the second kind ---
MODE_WORDS = [
    ("hibrido", r"\bhibrido\b|\bhybrid\b"),
    (
        "remoto",
        r"\bremoto\b|\bremote\b|home\s*office|100%\s*remoto|trabalho remoto|anywhere",
    ),
    ("presencial", r"\bpresencial\b|on[\s\-]?site|\bno local\b|\bpresential\b"),
]
MODES = [label for label, _ in MODE_WORDS]

# --- levels, on spelled lower-case titles ---
LEVEL_PATTERNS = [
    ("estagio", r"\bestagi|\btrainee\b|\bintern\b|interns?hip|\bstagiaire\b"),
    ("junior", r"\bjr\b|\bjunior\b|\bjr\.|j[uú]nior"),
    (
        "pleno",
        r"\bpl\b|\bpl\.|\bpleno\b|\bplena\b|midlevel|mid-level|mid level"
        r"|\bintermediate\b|intermediari[oa]",
    ),
    ("senior", r"\bsr\b|\bsr\.|s[eê]nior\b|\bstaff\b"),
]
LEVEL_DEFAULT = "nao_especificado"
LEVEL_LABELS = {
    "estagio": "Estágio",
    "junior": "Júnior",
    "pleno": "Pleno",
    "senior": "Sênior",
    "nao_especificado": "Não especificado",
}

# --- position groups, on spelled lower-case titles; the first rule with a keyword
# contained in the title wins ---
POSITION_DEFAULT = "Not Data Role"
# Groups left out of the level shares.
POSITION_EXCLUDED = ["Not Data Role", "Data Talent Pool"]
# Keywords that cannot change a result (they contain another keyword of their own
# or of an earlier rule) are left out.
POSITION_RULES = [
    ("Data Talent Pool", ["banco de talentos"]),
    (
        "Not Data Role",
        [
            "analista de ia",
            "consultor ti - ia",
            "consultor ti ia",
            "analista de monitoramento",
            "prevencao de perdas",
            "analista de sustentabilidade",
            "analista administrativo",
            "relacoes institucionais",
            "analista de melhoria continua",
            "analista de gestao",
            "analista sistema de gestao",
            "analista de controle e gestao",
            "analista de cadastro",
            "analista nto",
            "engenheiro de sistemas",
            "analista de sistemas jr",
            "coletor de dados",
            "bolsista de inovacao",
            "assistente de qualidade",
            "analista de atrativos",
            "analista jr de projetos de engenharia",
            "servicos externos",
        ],
    ),
    (
        "Data Leadership",
        [
            "gerente de dados",
            "lead dados",
            "lead de dados",
            "data lead",
            "head of data",
            "tech lead",
            "data engineering lead",
            "data analytics coordinator",
            "data science coordinator",
            "coordenador de dados",
            "engineering manager",
        ],
    ),
    (
        "Data Product",
        ["data product owner", "data product manager", "data products specialist"],
    ),
    ("Data Architect", ["data architect", "arquiteto de dados"]),
    ("Data Governance", ["governanca de dados", "data governance"]),
    (
        "Data Scientist",
        [
            "data scientist",
            "data science",
            "cientista de dados",
            "cientista dados",
            "ciencia de dados",
            "machine learning",
            "mlops",
            "artificial intelligence",
            "inteligencia artificial",
            "genai",
            "generative ai",
            "ai engineer",
        ],
    ),
    (
        "Analytics Engineer",
        [
            "analytics engineer",
            "data analyst engineer",
            "engenharia de analytics",
            "engenheiro de analytics",
            "engenharia de dados & analytics",
            "engenharia de dados e analytics",
            "plataforma de analytics",
        ],
    ),
    (
        "Data Engineer",
        [
            "data engineer",
            "engenheiro de dados",
            "engenheira de dados",
            "engenheiro a de dados",
            "engenharia de dados",
            "eng de dados",
            "engenheiro de banco de dados",
            "engenheiro solucoes dados",
            "data solutions",
            "engenheiro de confiabilidade de banco de dados",
            "etl engineer",
            "desenvolvimento de etl",
            "dados e etl",
            "snowflake engineer",
            "data platform engineer",
            "plataforma de dados",
            "dataops engineer",
            "database reliability engineer",
            "data quality engineer",
            "data management engineer",
            "especialista engenharia dados",
            "suporte de banco de dados",
            "suporte de banco dados",
            "dev banco dados",
            "dev banco de dados",
            "databricks",
        ],
    ),
    (
        "BI Analyst",
        [
            "business intelligence",
            " bi ",
            "de bi",
            "a bi",
            "power bi",
            "inteligencia comercial",
            "inteligencia de mercado",
            "inteligencia de negocios",
            "inteligencia competitiva",
            "inteligencia operacional",
            "people analytics",
            "data analytics",
            "data & analytics",
            "data visualization",
            "martech analyst",
            "analytics intern",
            "specialista em analytics",
            "indicadores",
        ],
    ),
    (
        "Data Analyst",
        [
            "analista de dados",
            "analista dados",
            "analistas de dados",
            "data analyst",
            "datahub analyst",
            "data migration analyst",
            "data automation analyst",
            "data development analyst",
            "data intelligence analyst",
            "market intelligence analyst",
            "dados junior",
            "dados pleno",
            "dados senior",
            "pleno de dados",
            "senior de dados",
            "junior de dados",
            "planejamento dados",
            "planejamento e dados",
            "operacoes de dados",
            "projetos de dados",
            "projetos e dados",
            "validacao de dados",
            "migracao de dados",
            "inteligencia de dados",
            "especialista dados",
            "especialista em dados",
            "especialista de dados",
            "finance data specialist",
            "analista de modelagem de dados",
            "analista de base de dados",
            "ti e dados",
            "logistico de dados",
            "analise de dados",
            "foco em dados",
            "data & ai",
        ],
    ),
    ("Data Intern", ["intern", "estagi", "stagiaire", "trainee"]),
]

# --- skill names: spelled lower-case name -> standard name ---
SKILL_NAMES = {
    "aws": "AWS",
    "amazon web services": "AWS",
    "amazon web services (aws)": "AWS",
    "gcp": "Google Cloud Platform",
    "google cloud": "Google Cloud Platform",
    "google cloud platform (gcp)": "Google Cloud Platform",
    "azure": "Azure",
    "microsoft azure": "Azure",
    "cosmosdb": "Azure Cosmos DB",
    "azure cosmos db": "Azure Cosmos DB",
    "cosmos db": "Azure Cosmos DB",
    "powerbi": "Power BI",
    "power bi": "Power BI",
    "microsoft power bi": "Power BI",
    "excel": "Microsoft Excel",
    "microsoft excel": "Microsoft Excel",
    "excel avancado": "Microsoft Excel",
    "excel intermediario": "Microsoft Excel",
    "postgres": "PostgreSQL",
    "postgresql": "PostgreSQL",
    "ms sql server": "SQL Server",
    "sql server": "SQL Server",
    "mssql": "SQL Server",
    "microsoft sql server": "SQL Server",
    "phyton": "Python",
    "python": "Python",
    "pyspark": "PySpark",
    "spark": "Apache Spark",
    "apache spark": "Apache Spark",
    "dbt (data build tool)": "dbt",
    "dbt core": "dbt",
    "dbt": "dbt",
    "llms": "LLM",
    "llm": "LLM",
    "large language models (llms)": "LLM",
    "large language models": "LLM",
    "comunicacao": "Comunicação",
    "organizacao": "Organização",
    "lideranca": "Liderança",
    "resolucao de problemas": "Resolução de Problemas",
    "pensamento analitico": "Pensamento Analítico",
    "visao estrategica": "Visão Estratégica",
}
# Tested in this order when the exact map has no entry.
SKILL_NAME_PARTS = [
    ("Azure Cosmos DB", ["cosmos"]),
    ("Databricks", ["databricks"]),
    ("Google BigQuery", ["bigquery", "big query"]),
    ("Machine Learning", ["machine learning"]),
    ("Comunicação", ["comunicacao"]),
]

# --- skill type: spelled lower-case standard names of soft skills ---
SOFT, TECHNICAL = "soft", "tecnica"
SOFT_SKILLS = [
    "comunicacao",
    "trabalho em equipe",
    "proatividade",
    "resolucao de problemas",
    "pensamento analitico",
    "organizacao",
    "autonomia",
    "lideranca",
    "curiosidade",
    "storytelling",
    "visao estrategica",
]

# --- page markup ---
# Selectors of one posting page, and the pattern of a posting id in a result page.
TITLE_SELECTORS = ["h2.top-card-layout__title.topcard__title"]
COMPANY_IMAGE = "img[data-ghost-classes=artdeco-entity-image--ghost]"
COMPANY_LINK = "a.topcard__org-name-link"
CITY_SELECTOR = ".topcard__flavor.topcard__flavor--bullet"
BODY_SELECTOR = ".show-more-less-html__markup"
ID_PATTERN = r'data-entity-urn="urn:li:jobPosting:(\d+)"'
RESULTS_PER_PAGE = 10
