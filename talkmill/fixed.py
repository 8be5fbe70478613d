"""Word lists, prompts, patterns and constants that results
depend on.  They must stay exactly as they are."""

# Characters that str.split() and str.strip() treat as blanks: as a class body
# for patterns with the (?U) flag, and one by one.
BLANKS = r"\s\x1c-\x1f"
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# CJK unified ideographs, the range that marks wrong-script text.
CJK = r"[\u4e00-\u9fff]"

# Lead-ins removed from the first sentence of an assistant turn.
LEAD_INS = [
    "Chắc chắn rồi,",
    "Tuyệt vời!",
    "Chào bạn,",
    "Vào thời điểm bài báo được đăng tải,",
    "Thưa quý vị,",
]

# A first sentence holding one of these is dropped.
DROP_FIRST_SENTENCE = [
    "cung cấp thông tin chi tiết",
    "gì tôi có",
    "gì tôi được biết",
    "thông tin đã được công bố",
]

# An assistant turn holding one of these (case-insensitive) is a refusal.
REFUSALS = [
    "tôi rất tiếc",
    "thông tin được cung cấp",
    "thời điểm bài viết được đăng tải",
    "thông tin có được",
    "tháng 5 năm 2025",
    "dựa trên thông tin",
]

# A question holding one of these needs its source text.
CONTEXT_WORDS = ["theo", "này", "giá", "trên"]

# Initials such as N.Q.A.
INITIALS = r"[A-Z](\.[A-Z])+\."

# First message of a conversation whose context was missing.
NULL_CONTEXT = "<content>\n\nnone\n\n</content>"

# Text put around the source text of a context-dependent conversation.
CONTEXT_BEFORE = "Bạn được cung cấp một đoạn văn bản sau:\n\n<content>\n\n"
CONTEXT_AFTER = "\n\n</content>\n\nDựa vào đoạn văn bản trên, hãy trả lời các câu hỏi sau:\n\n"

# Question and answer markers of generated text.
QUESTION_MARK = "### Question:"
ANSWER_MARK = "### Answer:"

# System message for conversations that have none.
DEFAULT_SYSTEM = "Bạn là trợ lý hữu ích. /no_think"

# System prompts of reasoning samples, by language pair.
REASONING_SYSTEM = {
    "en_en": [
        "You are a reasoning assistant. You must think about the reasoning process in mind then provide user with answer. The reasoning process are enclosed in <think> </think> /think",
        "You are a smart assistant /think",
        "You are a smart assistant /think",
    ],
    "vi_en": [
        "You are a reasoning assistant. You must think about the reasoning process in mind then provide user with answer. The reasoning process are enclosed in <think> </think> /english /think",
        "You are a smart assistant /english /think",
    ],
    "vi_vi": [
        "Bạn là trợ lí có khả năng suy nghĩ. Hãy suy nghĩ kĩ và trả lời câu hỏi của người dùng. Đặt phần suy nghĩ của bạn trong tag <think></think> /think",
        "Bạn là một trợ lý thông minh.  /think",
        "bạn là một trợ lý thông minh. /vietnamese /think",
    ],
}
REASONING_TRANSLATION = "The translation of the user request is:\n\n"
THINK_SUFFIX = " /think"

# Multiple-choice grading.
CHOICE_LETTERS = "ABCDEFabcdef"
ANSWER_LABEL = "Đáp án"
GRADING_SYSTEM = (
    "Bạn được cung cấp một câu hỏi trắc nghiệm và các lựa chọn trả lời.\n"
    "Hãy phân tích từng bước một cách cẩn thận trước khi chọn ra câu trả lời đúng nhất.\n"
    "Đáp án của bạn phải là một trong các lựa chọn A, B, C, D và được để trong \\boxed{} và viết hoa"
    " (ví dụ: \\boxed{A}). /think"
)
GRADING_QUESTION = "Câu hỏi:\n"
GRADING_CHOICES = "\n\nCác lựa chọn:\n"

# Training-set shape.
MAX_WORDS = 1000
MAX_CONVERSATIONS = 2
GROUP_SIZE = 16
ROWS_PER_FILE = 50_000
UPLOAD_ROWS = 1_000
EXPORT_CHUNK = 5_000
EXPORT_LIMIT = 1_000_000

# Work queues and triggers.
NEW_ROWS_THRESHOLD = 500
GENERATION_LIMIT = 3_000
CHAT_PAGE_SIZE = 20
CHAT_QUOTA = {"guest": 20, "regular": 100}
QUOTA_HOURS = 24
MAX_MESSAGE_CHARS = 2_000
IMAGE_TYPES = ["image/png", "image/jpg", "image/jpeg"]

# Log following (seconds).
POLL_SECONDS = 15
STALL_SECONDS = 180
UPLOAD_SECONDS = 300
STALL_FACTOR_BEFORE_START = 8

# Text stand-ins for missing and boolean values.
MISSING_WORDS = ["nan", "None", ""]
TRUE_WORD, FALSE_WORD = "True", "False"

# Rows read by template.
TEMPLATE_TABLES = {"qwen3": ["thinking", "sft"], "r1": ["thinking"]}
OTHER_TEMPLATE_TABLES = ["sft"]
