"""Closed domains and thresholds of the conversation model.

Fixed values: they must equal those the results are compared with.
"""

STEP_IDS = ("1", "2", "3", "3.5", "5", "6", "7", "fup1", "fup2")
STEP_CONTEXTS = ("on_script", "off_script", "transition", "unknown")
POLARITIES = ("pos", "neu", "neg")
OUTCOMES = ("booked", "lost", "ambiguous")
UNKNOWN = "unknown"
OBJECTION_IDS = ("price", "location", "time_slot", "competitor", "hesitation_vou_pensar", "delegated_talk_to_someone", "delayed_response_te_falo", "trust_boundary_male", "other")
#: A customer message confirms when it holds one of these, inside words too.
CONFIRMATIONS = ("ok", "okay", "perfeito", "confirm", "fechad", "combinad", "obrigad", "agendad", "até ", "ate ", "pode ser", "valeu", "maravilh", "beleza", "show", "blz", "👍")
#: Records that stand for no answer and are asked for again.
STUB_CRITIQUE, STUB_EVIDENCE = "(não avaliado)", "(stub)"
#: Stages that need their sections and tables by these names.
SECTIONS = (
    "## 1. Resumo executivo",
    "## 2. Análise por etapa do script",
    "## 3. O que dizemos que funciona (top 10 templates positivos)",
    "## 4. O que dizemos que pode melhorar (top 10 templates negativos)",
    "## 5. Viradas de jogo (top 20 turnarounds)",
    "## 6. Padrões de argumentação vencedora",
    "## 7. Lacunas no script",
)
DEAL_COLUMNS = ("telefone", "data", "tipo_objecao", "mensagem_cliente", "resposta_vencedora", "confirmacao", "labels")
CSV_COLUMNS = {
    "turnarounds.csv": DEAL_COLUMNS,
    "lost_deals.csv": DEAL_COLUMNS,
    "per_step.csv": ("step_id", "on_script_count", "off_script_count", "top_intents", "top_objections", "top_clusters"),
    "spa_templates_scored.csv": ("template_id", "canonical_text", "instance_count", "warmth", "clarity", "script_adherence", "polarity", "critique"),
    "off_script_clusters.csv": ("step_id", "medoid_text", "size", "example_msg_ids"),
}

MIN_MESSAGES = 20
FUZZY_THRESHOLD = 88
HINT_MESSAGES, HINT_CHARS = 3, 140
CUSTOMER_BATCH, SENTIMENT_BATCH = 15, 10
HEAD, TAIL, RADIUS, TOKEN_BUDGET = 15, 15, 10, 3000
TOP_VALUES, TOP_TEMPLATES, TOP_DEALS, EXAMPLES = 5, 10, 20, 5
MIN_CLUSTER = 3
EXCERPT_CHARS = 200

SCHEMAS = {
    "message": "chat_id long, msg_id long, ts_ms long, from_me boolean, text string, text_raw string, phone string",
    "conversation": "chat_id long, phone string, messages array<struct<msg_id:long,ts_ms:long,from_me:boolean,text:string,text_raw:string>>",
    "template": "template_id long, canonical_text string, instance_count long, example_msg_ids array<long>, first_seen_ts long, last_seen_ts long",
    "template_label": "template_id long, step_id string, matches_script boolean, deviation_note string",
    "customer_label": "msg_id long, step_context string, intent string, objection_type string, sentiment string",
    "labelled": "msg_id long, chat_id long, from_me boolean, step_id string, step_context string, intent string, objection_type string, sentiment string, matches_script boolean, deviation_note string",
    "sentiment": "template_id long, warmth int, clarity int, script_adherence int, polarity string, critique string",
    "conversion": "chat_id long, phone string, conversion_score int, conversion_evidence string, first_objection_idx int, first_objection_type string, resolution_idx int, winning_reply_excerpt string, final_outcome string",
}
