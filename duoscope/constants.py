"""Vocabularies, limits and formats that results depend on.

Everything here is data. Operators take these values as parameters and only use
them as defaults.
"""

# Pipeline stages and statuses.
RETRY_STAGES = ("prepare", "run", "collect", "score", "finalize")
ARM_STAGES = ("run", "collect", "score")
RETRYABLE_STATUSES = ("failed", "partial", "draft")
SALVAGEABLE_STATUSES = ("running", "error", "failed", "timeout")
DOWNSTREAM = {
    "prepare": ("run", "collect", "score", "finalize"),
    "run": ("collect", "score", "finalize"),
    "collect": ("score", "finalize"),
    "score": ("finalize",),
    "finalize": (),
}

# Model-name keywords, in order of priority.
PROVIDER_KEYWORDS = (("qwen", ("qwen",)), ("claude", ("claude",)))
IDENTITY_KEYWORDS = {"qwen": ("qwen",), "claude": ("claude", "anthropic")}

# Acceptance limits.
BASELINE_MAX = 0.7
CANDIDATE_MIN = 0.7
GAIN_MIN = 0.25
MIN_CRITERIA = 7
MAX_CRITERIA = 10
MIN_LINES = 10
MIN_SALVAGE_LINES = 3
MIN_TURNS = 2
MAX_TURNS = 8

# Columns of the published submission table, internal name -> header.
# "{baseline}" and "{candidate}" stand for the names of the two arms.
SUBMISSION_HEADERS = {
    "id": "id",
    "baseline_trajectory": "{baseline} 本地trajectory",
    "baseline_session_id": "{baseline} session id",
    "baseline_score_path": "{baseline} rubrics 人工评分",
    "candidate_trajectory": "{candidate} 本地trajectory",
    "candidate_session_id": "{candidate} session id",
    "candidate_score_path": "{candidate} rubrics 人工评分",
    "baseline_passrate": "{baseline} passrate",
    "candidate_passrate": "{candidate} passrate",
    "task_type": "任务类型",
    "domain": "应用领域",
    "language": "编程语言",
    "bad_pattern": "命中QwenBad Pattern",
}

# Bad-pattern keys with their texts.
BAD_PATTERNS = {
    "lazy_shortcut": "偷懒 - 模型只做核心功能，忽略隐式质量要求",
    "poor_interaction": "交互不通畅 - 模型不与用户确认就直接执行",
    "github_based": "基于GitHub的题目 - 需要web search定位旧版本bug",
    "environment_dependency": "环境依赖 - venv/cuda/python版本等环境陷阱",
    "instruction_follow": "指令follow - 不遵循CLAUDE.md或项目约束",
    "attachment_binary": "附件处理不足 - 不主动处理PDF/zip/图片等附件",
    "planning_only": "只做准备/只写计划 - 不执行实质动作或不使用自定义工具",
    "macos_development": "macOS开发能力不足 - 套用Linux方案",
    "parallel_tool_usage": "并行能力不足 - 串行处理可并行子任务",
}
BAD_PATTERN_MARKERS = ("Bad Pattern 命中", "Bad Pattern命中", "bad pattern")
BAD_PATTERN_NONE = ("未发现", "未命中", "无明确", "无命中")

# Words in a rationale that contradict a high or a low score.
NEGATIVE_WORDS = (
    "没有", "没看到", "未完成", "不够", "缺少", "缺乏", "不足",
    "欠缺", "偏弱", "不完整", "还差", "没做", "不到位", "不算完成",
)
POSITIVE_WORDS = (
    "完整实现", "全部完成", "准确定位", "正确修复", "覆盖全面",
    "高质量", "完美", "出色", "处理得当", "完整覆盖",
    "成功修复", "成功实现", "精准定位", "全面覆盖",
)

# Tool inputs shown at greater length in a condensed session.
TOOL_KEY_FIELDS = {
    "Edit": ("old_string", "new_string", "file_path"),
    "Write": ("file_path", "content"),
    "Bash": ("command",),
}

# Names that no path component may have.
RESERVED_NAMES = (
    "CON", "PRN", "AUX", "NUL",
    "COM1", "COM2", "COM3", "COM4", "COM5", "COM6", "COM7", "COM8", "COM9",
    "LPT1", "LPT2", "LPT3", "LPT4", "LPT5", "LPT6", "LPT7", "LPT8", "LPT9",
)

# Health points per finding.
HEALTH_POINTS = {
    "permanently_failed": 10,
    "failed": 3,
    "partial": 1,
    "stuck": 2,
    "violations": 5,
    "missing": 4,
}
HEALTH_CRITICAL_POINTS = 15
STUCK_RETRIES = 2
