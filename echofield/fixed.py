"""Word lists, patterns, thresholds and sentences the results depend on."""

# --- fixed values: Hindi words in Latin script ------------------------------------------------
HINGLISH_WORDS = (
    "nahi hai tha the kya aur bhi bahut bohot achha acha accha mujhe mera meri mere humara "
    "unka unki unhone karo karta karti karte agar toh to phir lekin par woh yeh ye jo jab "
    "kab kaise kyun sirf sab sabhi paise paisa baar bar gaya gayi gaye mila mili mile "
    "diya liya kiya hua hui hue raha rahi rahe wala wali waale bilkul sahi "
    "galat bura buri bure acchi bekaar bekar"
).split()
# The list holds common English words; the strict list leaves them out.
HINGLISH_ENGLISH_OVERLAP = "the to par bar mere".split()

# --- fixed values: severity and driver words --------------------------------------------------
LEGAL_TERMS = ["fraud", "legal", "police", "consumer court", "ncdrc", "chargeback", "harassment", "scam"]
MONEY_TERMS = ["refund", "money", "charged", "payment", "upi", "wallet", "bank", "transaction", "deducted"]
DRIVER_LEGAL_WORDS = ["fraud", "legal", "consumer court", "scam", "police", "chargeback"]
DRIVER_MONEY_WORDS = ["refund", "charged", "payment", "money", "upi", "transaction"]
GOLD_WORD_PAIR = ("double", "charged")
SEVERITY_NAMES = {0: "Low", 1: "Medium", 2: "High"}
DRIVER_NAMES = {
    "legal": "Legal/fraud keywords",
    "money": "Money/payment issue terms",
    "stars": "Low star rating",
    "thumbs": "High community engagement",
    "length": "Long detailed complaint",
    "exclaim": "Strong emotional punctuation",
    "none": "No strong high-risk cues detected",
}

# --- fixed values: cluster names by cluster number --------------------------------------------
CLUSTER_NAMES = {
    0: "Delivery Failure",
    1: "Refund & Payment Issues",
    2: "Fake/Counterfeit Product",
    3: "App Crash / UX Bug",
    4: "Size/Quality Mismatch",
    5: "Positive Experience",
    6: "Return/Cancellation Problem",
    7: "Other Complaints",
}

# --- fixed values: reply sentences; {route} is the slot ---------------------------------------
REPLY_TEMPLATES = {
    "template_v1": (
        "We are sorry for this experience regarding {route}. "
        "Please share your order ID via in-app support so our team can resolve this quickly."
    ),
    "template_v2": (
        "Thank you for reporting this {route} issue. We understand the inconvenience. "
        "Our specialist team will review the case and provide an update within 24 hours."
    ),
    "template_v3": (
        "We regret the trouble. For {route} complaints, please contact support with transaction/order details. "
        "If this involves payment, we will prioritize verification and refund checks."
    ),
    "template_v4": (
        "Hi — we have logged your {route} concern. A support associate will reach out with next steps "
        "and timelines after verifying your order and payment details."
    ),
}
SHORT_REPLIES = [
    "We are sorry for this {route} issue. Please share order ID and our team will resolve quickly.",
    "Thank you for reporting this {route} complaint. We understand the inconvenience and will update you within 24 hours.",
    "We regret the trouble. Please contact support with transaction details for priority handling and closure.",
]
EMPATHY_WORDS = ["sorry", "apologize", "understand", "regret"]
ACTION_WORDS = ["share", "provide", "check", "resolve", "contact", "update", "refund"]
BLAME_WORDS = ["fault", "blame", "ignore"]

# --- fixed values: retrieval -------------------------------------------------------------------
REFUSAL_SENTENCE = "Not enough evidence in the retrieved reviews to answer this."
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25
RRF_DAMPING = 60
SHORTLIST = 40
POOL_DEPTH = 12
ANSWER_K = 8
METRIC_KS = (1, 3, 5, 8)
VARIANTS = ("dense", "hybrid", "rerank")

# --- fixed values: function words per language (our own short lists) ---------------------------
STOP_WORDS = {
    "en": "the of and to in is that it for as was with be by on this are from or at".split(),
    "fr": "le la les de des du et un une est que qui dans pour sur au aux avec par pas".split(),
    "de": "der die das und den von zu ein eine ist mit sich auf dem nicht auch im es sie wir".split(),
    "es": "el la los las de del y que en un una es por con para se lo al su no".split(),
}
