"""Fixed values.

FIXED VALUES — these must equal the values the original calibration and
inference scripts use, so that prompts, token ids and defaults give the same
results.  They are stated plainly, in their natural order.
"""

# --- fixed values: image caption prompts (Chinese list, then English list) ---
ZH_IMAGE_PROMPTS = (
    "请用简体中文详细描述图片内容。",
    "请用简体中文概括图片中的主要物体、场景和动作，不要重复。",
    "请观察图片，并用自然的中文回答图片里有什么。",
    "请用简体中文描述这张图片，回答要准确、简洁。",
)
EN_IMAGE_PROMPTS = (
    "Please describe this image in detail.",
    "Please identify the main objects, scene, and actions in this image.",
)

# --- fixed values: default system prompts (Chinese, English) ---
SYSTEM_PROMPT_ZH = (
    "请使用和用户问题相同的语言回答。用户用中文提问时，只用简体中文回答；"
    "用户用英文提问时，只用英文回答。不要中英混杂，不要重复同一句话。"
)
SYSTEM_PROMPT_EN = (
    "Answer in the same language as the user's question. If the user asks in Chinese, "
    "answer only in Simplified Chinese; if the user asks in English, answer only in English. "
    "Do not mix languages or repeat the same sentence."
)

# --- fixed values: keys a model batch may carry ---
MODEL_INPUT_KEYS = (
    "input_ids",
    "attention_mask",
    "position_ids",
    "pixel_values",
    "pixel_values_videos",
    "image_grid_thw",
    "video_grid_thw",
    "mm_token_type_ids",
)

# --- fixed values: special token ids of the vision-language vocabulary ---
VISION_START_ID = 151652
VISION_END_ID = 151653
IMAGE_PAD_ID = 151655
VIDEO_PAD_ID = 151656

# --- fixed values: defaults of the calibration build ---
NUM_CALIB = 1024
NUM_IMAGE_CALIB = 768
NUM_TEXT_CALIB = 256
SEED = 42
TEXT_SEEDS = {"zh": 42, "en": 43}
SHUFFLE_BUFFER = 10000
MIN_TEXT_CHARS = 128
MAX_TEXT_CHARS = 1536
MIN_TOKENS = 10          # a sample with <= this many tokens is "short"
MAX_TOKENS = 2048        # a sample with more is "long"; 0 = no cap
IMAGE_MAX_PIXELS = 384 * 384
IMAGE_MIN_PIXELS = 256 * 256
PATCH_SIZE = 16
TEMPORAL_PATCH = 2
MERGE_SIZE = 2
CHUNK_LEN = 128
PREFILL_LEN = 1152
CONTEXT_LEN = 2047
TOP_K = 20
TOP_P = 0.8
TEMPERATURE = 0.7
PIXEL_MEAN = 127.5
PIXEL_STD = 127.5
TEXT_SOURCE_PREFIX = "wikipedia_"
IMAGE_SOURCE = "coco_caption"

# Unicode whitespace as Python's str.split() sees it (ASCII \t..\r, the four
# information separators \x1c..\x1f, space, NEL, NBSP, Ogham space, the
# U+2000..U+200A spaces, line/paragraph separators, narrow NBSP, medium
# mathematical space, ideographic space).  U+200B is not whitespace.
WHITESPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set as single characters (for translate()).
WHITESPACE_CHARS = "".join(
    chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
# CJK unified ideographs block only (kana, hangul and extensions excluded).
CJK_CLASS = r"[\x{4e00}-\x{9fff}]"
