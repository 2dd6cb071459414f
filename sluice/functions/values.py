"""Word lists, templates and weights of the water domain.

Every list below must equal the values users of the domain pipeline already
rely on, so they are stated here as plain data and used nowhere else as code.
"""

# ---- fixed values: cleaning -------------------------------------------------
FULL_WIDTH = "，。！？；：（）【】《》"
ASCII_FORM = ",.!?;:()[]<>"
PROTECTED_TERMS = [
    "水文", "气象", "降雨", "径流", "蒸发", "渗透", "地下水", "地表水",
    "水库", "大坝", "堤防", "水闸", "泵站", "灌溉", "排涝", "防洪",
    "水质", "水量", "水位", "流量", "流速", "含沙量", "溶解氧",
    "流域", "水系", "河道", "河床", "河岸", "河口", "三角洲",
    "洪水", "枯水", "丰水", "平水", "汛期", "枯水期", "丰水期",
    "水库调度", "水资源", "水环境", "水生态", "水安全", "水管理",
]
KEPT_MARKS = "。！？；："
GATE_CHARACTERS = "水文雨河湖库坝防洪涝"
DUPLICATE_REASON = "重复数据"

# ---- fixed values: knowledge base -------------------------------------------
KB_TERMS = {
    "水文": ["水文学", "水文分析", "水文资料"],
    "降雨": ["降水", "降雨量", "降水量", "降雨强度"],
    "径流": ["地表径流", "地下径流", "径流量", "径流系数"],
    "蒸发": ["蒸发量", "蒸发能力", "蒸散发"],
    "渗透": ["入渗", "下渗", "渗透率", "渗透系数"],
    "流域": ["集水区", "汇水区", "流域面积", "分水岭"],
    "河流": ["河道", "河床", "河岸", "河口"],
    "湖泊": ["水库", "人工湖", "天然湖", "湖泊水位"],
    "地下水": ["含水层", "地下水位", "地下水补给"],
    "大坝": ["水坝", "堤坝", "重力坝", "拱坝"],
    "水闸": ["节制闸", "泄洪闸", "冲沙闸"],
    "堤防": ["防洪堤", "海堤", "河堤"],
    "泵站": ["抽水站", "排水泵站", "灌溉泵站"],
    "防洪": ["防洪工程", "防洪标准", "洪水预警"],
    "灌溉": ["农田灌溉", "节水灌溉", "灌溉制度"],
    "排涝": ["排水", "除涝", "排水系统"],
    "供水": ["水源地", "供水工程", "水质保障"],
    "水质": ["水环境", "水污染", "水质监测"],
    "水生态": ["生态系统", "生物多样性", "生态保护"],
    "水土保持": ["土壤侵蚀", "植被恢复", "综合治理"],
}
KB_ENTITIES = {
    "长江": {"type": "河流", "length": "6300km", "basin_area": "180万km²"},
    "黄河": {"type": "河流", "length": "5464km", "basin_area": "79.5万km²"},
    "三峡": {"type": "水利工程", "purpose": "防洪、发电、航运"},
    "南水北调": {"type": "调水工程", "routes": "东线、中线、西线"},
}
KB_RELATIONS = [
    ("长江", "流经", "三峡"),
    ("三峡", "是", "水利工程"),
    ("南水北调", "连接", "长江"),
    ("南水北调", "连接", "黄河"),
]
TERM_INDICATORS = "水文雨洪涝旱河湖库坝闸泵灌排"
TERM_TYPES = {"term": "专业术语", "entity": "实体", "suspected": "疑似专业术语", "english": "English专业术语"}
TERM_CONFIDENCE = {"term": 0.9, "entity": 0.95, "suspected": 0.7, "english": 0.8}
ENGLISH_TERMS = [
    "hydrology", "water", "river", "dam", "reservoir", "flood",
    "drought", "precipitation", "evaporation", "runoff", "watershed",
    "groundwater", "irrigation", "drainage", "water quality", "ecosystem",
]

# ---- fixed values: question templates, in choice order; the comparison type is last
QA_TEMPLATES = {
    "定义型": ["什么是{term}？", "{term}的定义是什么？", "请解释一下{term}的含义。"],
    "原理型": ["{term}的原理是什么？", "{term}是如何工作的？", "请说明{term}的工作机制。"],
    "应用型": ["{term}在实际中有什么应用？", "{term}的主要用途是什么？", "如何应用{term}解决实际问题？"],
    "计算型": ["如何计算{term}？", "{term}的计算公式是什么？", "请说明{term}的计算方法。"],
    "比较型": ["{term}和{other}有什么区别？", "{term}与{other}相比有什么优势？", "请比较{term}和{other}的特点。"],
}
DEFAULT_ANSWERS = {
    "定义型": "{term}是水利领域的重要概念，具体定义需要结合专业文献确定。",
    "原理型": "{term}的工作原理涉及多个水利专业知识点，需要详细分析。",
    "应用型": "{term}在水利工程中有重要应用，具体应用场景需要根据实际情况确定。",
    "计算型": "{term}的计算方法需要参考相关的水利计算规范和手册。",
    "比较型": "{term}与其他概念的比较需要从多个维度进行分析。",
}
FACT_UNITS = ["km", "mm", "m", "℃", "%", "万", "亿", "吨", "立方米"]
FACT_QUESTION = "文中提到的{fact}这个数据代表什么含义？"
FACT_ANSWER = "根据原文内容，{sentence}"
FACT_DOMAIN = "数据"
EXPLANATIONS = {
    "水文": "研究水的各种现象和规律",
    "降雨": "大气中的水汽凝结后降落到地面的现象",
    "径流": "降水或融雪形成的地表水流",
    "蒸发": "水从液态转变为气态的过程",
    "流域": "分水线所包围的集水区域",
    "防洪": "防止洪水灾害的各种措施",
    "灌溉": "人为补给农田水分的措施",
}
DOMAIN_KEYWORDS = {
    "水资源": ["水资源", "水量", "用水", "供水", "节水"],
    "水文学": ["水文", "降雨", "径流", "蒸发", "渗透"],
    "水工程": ["大坝", "水闸", "堤防", "泵站", "水库"],
    "水环境": ["水质", "水环境", "污染", "生态", "保护"],
    "防洪": ["洪水", "防洪", "防汛", "预警", "调度"],
    "灌溉": ["灌溉", "农田", "排水", "旱情", "抗旱"],
}
TERM_DOMAINS = {
    "水文": "水文学", "降雨": "水文学", "径流": "水文学", "大坝": "水工程",
    "防洪": "防洪", "灌溉": "灌溉", "水质": "水环境",
}
DEFAULT_DOMAIN = "综合"

# ---- fixed values: quality scoring ------------------------------------------
DOMAIN_VOCABULARY = [
    "水文", "气象", "降雨", "降水", "径流", "蒸发", "渗透", "地下水", "地表水",
    "水位", "流量", "流速", "含沙量", "溶解氧", "水质", "水量", "水环境", "水生态",
    "流域", "水系", "河流", "河道", "河床", "河岸", "河口", "三角洲", "湖泊", "水库",
    "长江", "黄河", "珠江", "淮河", "海河", "松花江", "辽河",
    "大坝", "水坝", "堤坝", "水闸", "堤防", "泵站", "水电站", "拦河坝",
    "防洪", "排涝", "灌溉", "供水", "排水", "调水", "引水",
    "洪水", "枯水", "丰水", "平水", "汛期", "枯水期", "丰水期", "干旱", "洪涝",
    "暴雨", "特大暴雨", "连续降雨", "梅雨", "台风",
    "水文站", "雨量站", "水位站", "监测", "预报", "预警", "调度", "管理", "规划",
    "设计", "施工", "运行", "维护", "治理", "保护", "修复", "生态",
]
METRIC_WEIGHTS = {"completeness": 0.25, "relevance": 0.30, "consistency": 0.20, "diversity": 0.25}
CAUSE_WORDS = ["因为", "所以", "由于", "因此", "原因", "原理"]
APPLICATION_WORDS = ["应用", "使用", "方法", "措施", "技术"]
RELEVANCE_AREAS = {
    "水文": ["水文", "降雨", "径流", "蒸发", "水位", "流量"],
    "工程": ["大坝", "堤防", "水闸", "泵站", "水库", "工程"],
    "管理": ["管理", "调度", "运行", "维护", "监测", "预报"],
    "环境": ["水质", "水环境", "生态", "污染", "保护", "治理"],
}
SYNONYMS = {"降雨": ["降水"], "径流": ["水流"], "大坝": ["水坝", "堤坝"]}
TOPICS = {
    "数据": ["数据", "数值", "统计", "测量", "监测"],
    "技术": ["技术", "方法", "工艺", "方案", "措施"],
    "管理": ["管理", "制度", "政策", "规划", "调度"],
    "工程": ["工程", "建设", "施工", "设计", "维护"],
    "环境": ["环境", "生态", "保护", "治理", "修复"],
}
DESCRIPTION_MARKS = "，。！？；：\"（）【】"
CAUSAL_LINKS = ["因为", "所以", "由于", "因此"]
ORDER_LINKS = ["首先", "其次", "最后", "另外"]
QUESTION_WORDS = ["什么", "如何", "为什么", "怎样", "请", "解释"]
SUGGESTIONS = {
    "short": "内容较短，建议增加更多详细信息",
    "no_number": "缺少具体数据，建议添加相关数值信息",
    "no_term": "缺少专业术语，建议增加水利专业概念",
    "weak_relevance": "水利相关性较弱，建议增加专业领域内容",
    "no_relevance": "建议明确阐述与水利领域的关联性",
    "inconsistent": "内容一致性有待改善，建议检查术语使用和逻辑结构",
    "plain": "表达较为单一，建议丰富词汇和句式",
    "flat": "建议从多个角度展开描述，增加信息层次",
}

# ---- fixed values: enumerations ---------------------------------------------
DATA_TYPES = ["pdf", "text", "qa", "table", "image", "json", "csv", "markdown"]
LANGUAGES = ["zh", "en", "auto"]
WATERMARKS = ["Copyright", "Watermark", "Confidential"]
