"""Words, labels, texts, templates and thresholds that decide results.

Everything here is data that has to hold exactly these values for results to agree;
operators take each of them as a parameter and use these as the defaults.
"""

# --- fixed values: message table -------------------------------------------------
DEFAULT_BRAND = "AmazonHelp"
MESSAGE_COLUMNS = [
    "tweet_id", "author_id", "in_reply_to_tweet_id", "created_at", "text", "response_tweet_id",
]
MISSING_WORDS = ["nan", "None"]
MIN_TOKENS = 3
URL_PATTERN = r"https?://\S+|www\.\S+"
HANDLE_PATTERN = r"@[A-Za-z0-9_]+"
URL_PLACEHOLDER = "[URL]"

# --- fixed values: intents and keyword rules (order matters, first match wins) ---
INTENTS = [
    "DELIVERY_STATUS", "REFUND_RETURN", "CANCELLATION", "PAYMENT_CHARGE",
    "ACCOUNT_ACCESS", "DAMAGED_WRONG_MISSING_ITEM", "PRIME_SUBSCRIPTION", "GENERAL_OTHER",
]
GENERAL_INTENT = "GENERAL_OTHER"
INTENT_DESCRIPTIONS = {
    "DELIVERY_STATUS": "Queries regarding package tracking, shipment delays, delivery dates, or missing tracking info.",
    "REFUND_RETURN": "Requests or status checks for product returns, refund timelines, or return labels.",
    "CANCELLATION": "Requests to cancel an active order before delivery or order cancellation confirmations.",
    "PAYMENT_CHARGE": "Issues with billing, double charges, failed transactions, gift cards, or payment methods.",
    "ACCOUNT_ACCESS": "Difficulty logging in, password resets, account locking, OTP issues, or unauthorized access.",
    "DAMAGED_WRONG_MISSING_ITEM": "Reports of damaged goods, defective products, wrong item delivered, or missing items in box.",
    "PRIME_SUBSCRIPTION": "Questions or cancellation requests regarding Amazon Prime membership, video streaming, or Prime benefits.",
    "GENERAL_OTHER": "General questions, customer feedback, praise, store inquiries, or non-actionable complaints.",
}
KEYWORD_RULES = {
    "DELIVERY_STATUS": ["where is my order", "track", "delivery", "delivered", "shipping", "shipped", "carrier", "late", "eta", "driver", "package"],
    "REFUND_RETURN": ["refund", "return", "return label", "money back", "reimburse", "credited"],
    "CANCELLATION": ["cancel", "cancellation", "cancelling", "stop order"],
    "PAYMENT_CHARGE": ["charged", "payment", "billing", "card", "double charge", "invoice", "overcharge", "gift card"],
    "ACCOUNT_ACCESS": ["login", "password", "account", "otp", "sign in", "locked", "unauthorized", "hacked", "email reset"],
    "DAMAGED_WRONG_MISSING_ITEM": ["damaged", "broken", "wrong item", "missing item", "defective", "torn", "empty box", "faulty"],
    "PRIME_SUBSCRIPTION": ["prime", "membership", "subscription", "prime video", "auto renew"],
}
UNTRAINED_CONFIDENCE = 0.75

# --- fixed values: retrieval and features ----------------------------------------
TOP_K = 3
MAX_FEATURES = 5000
ZERO_NORM = 1e-10

# --- fixed values: routing -------------------------------------------------------
RISK_KEYWORDS = ["lawyer", "legal", "sue", "court", "hacked", "fraud", "unauthorized", "stolen card"]
SENSITIVE_INTENTS = ["ACCOUNT_ACCESS", "PAYMENT_CHARGE"]
MIN_CONFIDENCE = 0.65
MIN_RETRIEVAL_SIM = 0.45
GENERAL_MIN_CONFIDENCE = 0.8
ESCALATE_RISK = 0.5
RISK_WEIGHTS = {"keywords": 0.8, "sensitive": 0.5, "confidence": 0.4, "evidence": 0.4, "general": 0.3}
ACTION_ESCALATE = "ESCALATE_HUMAN"
ACTION_AUTO = "AUTO_HANDLE"
REASON_FORMATS = {
    "keywords": "Contains security/legal risk keywords: %s",
    "sensitive": "Intent '%s' involves sensitive financial or credential actions",
    "confidence": "Low intent classification confidence (%s < %s)",
    "evidence": "Weak historical retrieval evidence (similarity %s < %s)",
    "general": "Unclear/General query intent without high confidence pattern match",
}
NO_REASON = "High intent confidence and strong historical retrieval evidence."

# --- fixed values: replies -------------------------------------------------------
TRIVIAL_REPLY = "Hello! Thank you for reaching out to Amazon Help. Please send us a Direct Message (DM) with your order number so we can assist you further."
NEAREST_FALLBACK_REPLY = "Hello! Please send us a Direct Message (DM) with your order details so we can investigate this for you."
TEMPLATE_FALLBACK_REPLY = "Hello! Thanks for contacting Amazon Help. Please send us a DM with your order details so we can investigate."
REPLY_PREFIX = "Hello! "
REPLY_TEMPLATES = {
    "DELIVERY_STATUS": "We understand you are inquiring about your package delivery. Please send us a DM with your order ID so we can track the exact status for you.",
    "REFUND_RETURN": "For return or refund assistance, please send us a DM with your account email and order details so our team can process this promptly.",
    "CANCELLATION": "If you wish to cancel an order, please send us a DM right away with your order number so we can attempt cancellation before dispatch.",
    "PAYMENT_CHARGE": "For payment or billing inquiries, please DM us your order details and account email so we can verify charges safely.",
    "ACCOUNT_ACCESS": "For your security, account login issues must be handled via direct message. Please DM us your registered email address.",
    "DAMAGED_WRONG_MISSING_ITEM": "We are very sorry to hear your item arrived damaged or missing! Please send us a DM with photos and order details so we can arrange a replacement.",
    "PRIME_SUBSCRIPTION": "Regarding your Amazon Prime membership, please send us a DM with your account email so we can check your subscription details.",
    "GENERAL_OTHER": "Thanks for reaching out! Please send us a DM with further details so we can assist you right away.",
}
PRECEDENT_FORMAT = "Precedent %s (Similarity: %s):\n  Customer: %s\n  Support Resolution: %s"
NO_PRECEDENT = "No specific historical resolution found."
GROUNDED_PROMPT = """Customer Query:
"{query}"

Detected Intent: {intent}

Top Historical Support Resolutions (Proven precedents):
{context}

Generate a concise, professional customer support reply grounded ONLY in the precedents above.
"""
REPLY_SYSTEMS = ["trivial_baseline", "simple_1nn_baseline", "main_grounded_system"]

# --- fixed values: reply rubric --------------------------------------------------
GENERIC_PHRASES = ["send us a dm", "direct message"]
GENERIC_MAX_TOKENS = 20
VAGUE_INTENTS = ["GENERAL_OTHER", "PAYMENT_CHARGE"]
SPECIFIC_RELEVANCE_INTENTS = ["REFUND_RETURN", "DAMAGED_WRONG_MISSING_ITEM", "CANCELLATION"]
SPECIFIC_HELP_INTENTS = ["REFUND_RETURN", "DAMAGED_WRONG_MISSING_ITEM"]
GROUNDING_WORDS = ["dm", "refund"]
HELP_WORDS = ["dm", "direct message", "order", "track", "help"]
POLITE_WORDS = ["hello", "thanks", "thank you", "sorry", "apologize", "please"]
UNSAFE_WORDS = ["password", "card number", "ssn"]
PRIVATE_QUERY_WORDS = ["account", "pay"]
PROMISE_PHRASES = ["100% guarantee", "refunded immediately", "free prime for life"]
JUDGE_TYPE = "DeterministicRuleJudge"
RUBRIC_SCORES = ["relevance", "groundedness", "helpfulness", "tone", "safety", "hallucination_risk"]

# --- fixed values: failure analysis ----------------------------------------------
DEFAULT_OVERALL = 4.0
DEFAULT_HUMAN_RATING = 4.0
LOW_OVERALL = 3.5
OVERCAUTIOUS_CONFIDENCE = 0.8
NO_CASE_TEXT = "None"
FAILURE_TEXTS = {
    "Misclassified Intent": (
        "Overlapping domain vocabulary (e.g. delivery query mentioning refund or payment).",
        "Fine-tune domain-specific SentenceTransformer on customer support intent pairs."),
    "Unsafe Auto-Handle": (
        "Router confidence threshold was slightly too permissive for sensitive keyword variant.",
        "Lower confidence cutoff for financial/account intents and broaden security keyword filter."),
    "Low Groundedness / Response Quality": (
        "Historical vector retrieval did not find a closely matching precedent.",
        "Expand historical resolution vector index with more diverse brand precedents."),
    "Unnecessary Escalation": (
        "Overly cautious keyword trigger in router.",
        "Refine security keyword matcher to exclude benign contexts."),
}
WHAT_FAILED_FORMATS = {
    "Misclassified Intent": "Predicted intent '%s' instead of true gold intent '%s'.",
    "Unsafe Auto-Handle": "System auto-handled a query requiring human escalation.",
    "Low Groundedness / Response Quality": "Judge rating of %s/5.0 indicates sub-optimal resolution response.",
    "Unnecessary Escalation": "Straightforward query escalated to human agent, reducing automation efficiency.",
}
SUB_UNMAPPED = "Unmapped / Low-Confidence Fallback"
SUB_PRIME_DELIVERY = "Neighboring-Intent Confusion (Prime vs Delivery)"
SUB_REFUND_CHARGE = "Neighboring-Intent Confusion (Refund vs Charge)"
SUB_LOW_CONFIDENCE = "Low-Confidence Borderline (<30%)"
SUB_OTHER = "Ambiguous Query / Domain Overlap"
SUB_CONFIDENCE = 0.30

# --- fixed values: evaluation ----------------------------------------------------
SEED = 42
RATED_SAMPLE = 35
MIN_PAIRS = 50
SUPPLEMENT_ROWS = 500
MIN_TRAIN_ROWS = 10
SAMPLE_QUESTION = "Sample training customer query for {intent} issue #{i}"
SAMPLE_ANSWER = "Sample support resolution response for {intent}"
LEAK_ERROR = "[DATA LEAKAGE ERROR] {n} golden set examples found in training data! Example leaked item: '{example}'"
GOLDEN_ROWS = 200
SAMPLE_ROWS = 500

# --- fixed values: synthetic training pairs (intent, question, answer) -----------
TRAINING_TEMPLATES = [
    ("DELIVERY_STATUS", "Where is my package tracking #{id}? It says in transit for {days} days.", "Hello! Please DM us your order ID and address so we can check tracking status."),
    ("DELIVERY_STATUS", "Estimated delivery was 5 PM for order #{id}. Why is it delayed?", "We apologize for the delay! Please DM us your order number to track the driver."),
    ("REFUND_RETURN", "Returned item for order #{id} via UPS {days} days ago. Still waiting for refund.", "Hello! Refunds take 3-5 business days after carrier scan. DM us tracking to check."),
    ("REFUND_RETURN", "How do I print a return shipping label for order #{id}?", "You can generate a return label in Your Orders or DM us so we can email it."),
    ("CANCELLATION", "Please cancel my order #{id} placed 5 minutes ago.", "If the item hasn't shipped, we can cancel it! Please DM us your order details immediately."),
    ("PAYMENT_CHARGE", "Charged twice ${amt} on my Visa for order #{id}. Please refund double charge.", "We take billing issues seriously! Please DM us your order number so we can audit charges."),
    ("PAYMENT_CHARGE", "My gift card claim code says invalid or already redeemed for order #{id}.", "Please send us a DM with your gift card claim code so we can investigate."),
    ("ACCOUNT_ACCESS", "Cannot login to my account. OTP is not arriving on phone #{id}.", "For account access help, please DM us your registered email address for identity check."),
    ("ACCOUNT_ACCESS", "My account email address was changed without my permission! Lock it!", "Please DM us immediately so our Security team can lock unauthorized activity."),
    ("DAMAGED_WRONG_MISSING_ITEM", "Jar of peanut butter in order #{id} arrived shattered and leaking.", "So sorry for the damaged item! Please DM us photos and order details for a replacement."),
    ("DAMAGED_WRONG_MISSING_ITEM", "Received wrong item in order #{id}. Ordered medium shirt got small.", "Apologies for sending the wrong size! DM us your order ID so we can resend the item."),
    ("PRIME_SUBSCRIPTION", "Auto-renewed $14.99 for Prime membership #{id}. Cancel and refund please.", "If Prime benefits haven't been used, you are eligible for full refund! DM us to cancel."),
    ("GENERAL_OTHER", "What are customer support hours for Amazon Pantry order #{id}?", "Our Twitter support team is available 24/7! Send us a DM if you need help."),
    ("GENERAL_OTHER", "Kudos to Amazon delivery team for fast shipping on order #{id}!", "Thank you for the kind words! We will share your feedback with our delivery team."),
]
TRAINING_CREATED_AT = "Wed Oct 11 2017"

# --- fixed values: evaluation set, written rows ----------------------------------
# (pair_id, customer_tweet_id, customer_clean_text, support_response, gold_intent,
#  gold_should_escalate, human_quality_rating)
GOLDEN_LITERALS = [
    ("pair_101", "tw_101", "My package was supposed to arrive yesterday by 8 PM but tracking still says in transit. Where is it?", "We understand your concern regarding the delivery delay! Please send us a Direct Message (DM) with your order ID so we can investigate.", "DELIVERY_STATUS", False, 5.0),
    ("pair_102", "tw_102", "Hey Amazon, tracking shows delivered to receptionist but I live in an apartment with no front desk. Where is my item?", "Sorry to hear you haven't received your package! Please DM us your order number and full delivery address so we can locate it.", "DELIVERY_STATUS", False, 4.5),
    ("pair_103", "tw_103", "Delivery driver marked my shipment as attempted delivery but no one rang my doorbell all morning.", "We apologize for the inconvenience! Please DM us your order ID so we can coordinate with the local carrier for re-delivery.", "DELIVERY_STATUS", False, 4.0),
    ("pair_104", "tw_104", "Can I change the delivery address for order 402-9182312 since I won't be home tomorrow?", "Address changes depend on shipment status. Please DM us your order details and updated address right away.", "DELIVERY_STATUS", False, 4.0),
    ("pair_105", "tw_105", "Why is my package stuck at the local sorting facility for 3 days straight without updates?", "That certainly shouldn't happen! Please DM us your order number so we can reach out to the carrier for an update.", "DELIVERY_STATUS", False, 4.5),
    ("pair_201", "tw_201", "I dropped off my return package at UPS 5 days ago. When will the refund hit my bank account?", "Refunds usually process within 3-5 business days after carrier scan. Please DM us your tracking number and order details to verify.", "REFUND_RETURN", False, 5.0),
    ("pair_202", "tw_202", "The return portal won't let me print a QR code for my shoe return. Need a QR code instead of printed label.", "We can help generate a QR code! Please send us a DM with your order ID and return request details.", "REFUND_RETURN", False, 4.0),
    ("pair_203", "tw_203", "You issued a gift card balance refund instead of back to my original credit card. Please fix this!", "We apologize for the refund method mixup. Please send us a DM with your order number so we can adjust the refund destination.", "REFUND_RETURN", False, 4.5),
    ("pair_301", "tw_301", "I accidentally ordered two monitors instead of one. I clicked cancel order 5 minutes ago, will it be canceled?", "If the order hasn't entered dispatch, cancellation will succeed! DM us your order number so we can check immediate status.", "CANCELLATION", False, 4.5),
    ("pair_302", "tw_302", "Please cancel my subscribe and save order for coffee pods before it charges me next month.", "You can manage subscriptions under your account or DM us your email so we can assist you with cancellation.", "CANCELLATION", False, 4.0),
    ("pair_401", "tw_401", "I see two separate charges of $49.99 on my Visa statement for the exact same order. Need immediate refund for double charge!", "We take billing errors very seriously! Please send us a DM with your order number and email address so we can audit charges.", "PAYMENT_CHARGE", True, 4.5),
    ("pair_402", "tw_402", "My gift card code keeps saying already redeemed when I haven't used it. Was it stolen?", "For security reasons regarding gift cards, please send us a DM with your gift card details and order claim code.", "PAYMENT_CHARGE", True, 4.0),
    ("pair_501", "tw_501", "I am locked out of my Amazon account and the OTP is being sent to an old phone number I no longer have access to.", "We can help you update your verification phone number! Please DM us your registered account email address for identity check.", "ACCOUNT_ACCESS", True, 4.0),
    ("pair_502", "tw_502", "Someone logged into my account from abroad and ordered an expensive laptop. I suspect fraudulent unauthorized activity!", "Please reach out via DM immediately so our Account Security team can lock the unauthorized order and secure your account.", "ACCOUNT_ACCESS", True, 5.0),
    ("pair_601", "tw_601", "The glass jar of sauce inside my package arrived completely shattered and leaked all over the other items.", "We are so sorry for the damaged items! Please send us a DM with photos of the package and your order number for a replacement.", "DAMAGED_WRONG_MISSING_ITEM", False, 5.0),
    ("pair_602", "tw_602", "Ordered size 10 running shoes but received size 7 in the box. Wrong item sent.", "Apologies for sending the wrong size! Please DM us your order ID so we can send the correct item right away.", "DAMAGED_WRONG_MISSING_ITEM", False, 4.5),
    ("pair_701", "tw_701", "I was auto-renewed for Amazon Prime annual membership yesterday. Can I cancel and get a full refund?", "If Prime benefits haven't been used since renewal, you are eligible for a full refund! DM us your account email to proceed.", "PRIME_SUBSCRIPTION", False, 4.5),
    ("pair_801", "tw_801", "Shoutout to Amazon Help delivery team for getting my daughter's birthday gift delivered in terrible snow weather!", "Thank you so much for the kind words! We will pass this feedback to our local delivery team. Have a wonderful day!", "GENERAL_OTHER", False, 5.0),
]

# --- fixed values: evaluation set, template rows (intent, question, escalate, rating)
GOLDEN_TEMPLATES = [
    ("DELIVERY_STATUS", "Tracking for order #{id} has not updated for {days} days. Is it lost in transit?", False, 5.0),
    ("DELIVERY_STATUS", "Estimated delivery was 2 PM today for #{id}. Courier shows delayed, when will it arrive?", False, 4.0),
    ("REFUND_RETURN", "Returned item #{id} via UPS locker {days} days ago, still waiting for credit card refund.", False, 4.5),
    ("REFUND_RETURN", "How long does a refund take for order #{id} after dropoff at Kohl's?", False, 3.5),
    ("CANCELLATION", "Can I cancel order #{id}? It was placed by mistake 10 minutes ago.", False, 4.0),
    ("PAYMENT_CHARGE", "Unrecognized charge of ${amt} on my card under Amazon Market. Order #{id}.", True, 4.5),
    ("PAYMENT_CHARGE", "Payment failed for order #{id} but my bank account shows funds deducted.", True, 3.0),
    ("ACCOUNT_ACCESS", "Cannot receive 2FA verification SMS for my account login. Need help resetting.", True, 4.0),
    ("ACCOUNT_ACCESS", "My account email was changed without my authorization. Please lock account!", True, 5.0),
    ("DAMAGED_WRONG_MISSING_ITEM", "Box for order #{id} arrived crushed and internal monitor screen is cracked.", False, 4.5),
    ("DAMAGED_WRONG_MISSING_ITEM", "Order #{id} missing 1 out of 3 items listed on packing slip.", False, 3.5),
    ("PRIME_SUBSCRIPTION", "Charged $14.99 for Prime subscription #{id} without my consent. Cancel please.", False, 4.0),
    ("PRIME_SUBSCRIPTION", "Why am I not getting free 1-day delivery on Prime eligible item order #{id}?", False, 4.5),
    ("GENERAL_OTHER", "What are customer service contact hours for Amazon Pharmacy order #{id}?", False, 3.0),
    ("GENERAL_OTHER", "Great customer support service on my recent inquiry #{id}. Thank you Amazon!", False, 5.0),
]
GOLDEN_TEMPLATE_REPLY = "We apologize for the issue! Please send us a Direct Message (DM) with your order details so our team can assist you right away."
