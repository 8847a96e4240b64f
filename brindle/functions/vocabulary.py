"""The words, patterns and limits that inspection reports are read by.

They are data.  Every operator that uses one of them takes it as an argument with this default.
"""

from __future__ import annotations

# Recommendation categories, in report order, and the alias of the first.
CATEGORIES = ("立即处置", "尽快维修", "预防性养护")
CATEGORY_ALIAS = ("立即维修", "立即处置")

# Words by which an uncategorised recommendation is settled.
URGENT_WORDS = ("立即", "紧急", "危急", "封闭交通", "临时隔离")
REPAIR_WORDS = (
    "维修", "修复", "修补", "更换", "处治", "处置", "加固", "封闭", "灌浆", "灌缝", "堵漏", "补强",
    "除锈", "涂刷", "铺装", "勾缝", "抹灰", "恢复", "安装", "疏通", "清理堵塞",
)

# The lexical category policy, first rule that holds (all groups of a rule must hold; a group is a choice of words).
SAFETY_RISK = ("危及安全", "危及结构安全", "危及通行安全", "危及行人安全", "存在安全隐患", "存在安全风险")
CLEANING = ("清理", "清除")
CLOGGED = ("堵塞", "积土", "积水", "淤积", "泥沙", "垃圾")
ROUTINE_REPAIR = ("相关养护维修", "有关养护维修", "日常养护维修", "常规养护维修")
STANDARDS = ("养护规范", "养护技术规范")
NAMED_DEFECTS = ("裂缝", "破损", "刮痕", "渗水", "锈蚀")
CONCRETE_REPAIR = (
    "维修", "修复", "修补", "修理", "加固", "更换", "封闭", "灌浆", "堵漏", "补强", "除锈", "涂刷", "重新铺装", "重新勾缝", "勾缝",
    "抹灰", "灌封", "凿除重做", "凿除后", "恢复面层", "重新安装", "布置排水设施", "增设排水设施", "疏通", "灌缝", "填塞", "捣实", "抹平",
    "凿去", "刷洗", "抹压", "压实", "更换止水带", "凿除", "打磨后修补", "冲洗后修补",
)
MONITORING = (
    "检查", "日常养护", "日常维护", "观测", "巡查", "建立该桥", "技术档案", "加强观察", "加强日常观察", "定期观察", "加强监测", "定期监测",
    "定期复查", "日常复查", "定期清理", "日常清理", "常规保养", "维护管理", "严禁行人", "严禁超载", "严禁超速", "加强社会车辆", "设置明显的标识",
)
LOOSE_REPAIR = ("中修", "大修", "小修", "处理", "清理", "浇注", "恢复", "重装")

# Section titles by category, in the order that settles ties, and what tables say.
TITLES = (
    ("treatment_recommendations", ("处理建议", "处理意见", "处置建议", "处治建议", "病害处治", "建议措施", "处理措施", "处置措施", "处治措施", "维修处理", "维修处治", "加固处理")),
    ("safety_assessment", ("安全性评估", "安全评估", "安全影响", "结构安全", "安全性")),
    ("defect_table", ("病害明细表", "病害明细", "病害列表", "病害表", "缺陷明细", "缺陷表", "病害部位", "病害类型", "病害描述", "病害")),
    ("inspection_conclusion", ("检测结论", "详细结论", "总体结论", "评估结论", "检查结论", "综合评定", "检测结果", "结论")),
    ("recommendations", ("建议明细表", "建议明细", "主要建议", "维修建议", "养护建议", "建议措施", "维护建议", "建议表", "建议")),
    ("scoring", ("技术状况评分", "总体评分", "评分结果", "评分章节", "评分")),
)
CAUSE_WORDS = ("成因", "原因")
TABLE_DEFECTS = ("病害部位", "病害类型", "病害描述", "病害明细", "病害列表", "病害表", "缺陷明细", "缺陷表")
TABLE_SCORES = ("总体评分", "评分等级", "评分")
TABLE_SCORE_UNITS = ("等级", "分数", "评分")
TABLE_RECOMMENDATIONS = ("建议类别", "建议内容", "处理意见", "建议措施", "病害处治", "维修建议", "养护建议", "建议明细")
TABLE_TREATMENTS = ("处理建议", "处理意见", "处置建议", "处治建议", "建议措施", "病害处治")
TABLE_SAFETY = ("安全性评估", "安全评估")
TABLE_CONCLUSIONS = ("检测结论", "详细结论", "总体结论")
CONTAINER_TITLES = ("结论与建议", "结论及建议", "综合评估与建议", "评估结论与建议")
LEAF_TITLES = (
    "处理建议", "处理意见", "处置建议", "处治建议", "维修建议", "养护建议", "建议措施", "病害处治", "维护建议", "主要建议", "建议明细表", "建议明细",
    "建议列表", "建议表", "建议", "处理措施", "处置措施", "处治措施", "应采取的措施", "应立即维护的设施", "日常养护中采取措施", "日常养护中采取才措施",
)
TITLE_STYLES = ("title", "标题", "chaptertitle")
NUMBERING = r"^(?:第[0-9零一二三四五六七八九十百千万]+[章节篇条]?|[（(][0-9零一二三四五六七八九十百千万]+[）)]|[0-9]+(?:[.][0-9]+)*[、.:：)）]?|[零一二三四五六七八九十百千万]+[、.:：)）])"
HEADING_STYLE = r"(?i)(?:heading|标题)[ _-]?([1-9])"

# Words and limits of the concise summary texts.
NOISE = (
    "目录", "检测依据", "评定依据", "技术规范", "评定标准", "检查结果表", "病害分布表", "照片", "示意图", "布置图", "结构检算", "荷载试验", "静载试验",
    "动载试验", "自振频率", "冲击系数", "混凝土强度", "保护层合格率", "桥梁博士", "计算结果",
)
ACTIONS = ("建议", "应及时", "需及时", "维修", "修复", "修补", "处治", "处置", "加固", "更换", "清理", "养护", "可直接用", "环氧砂浆")
DEFECTS = ("病害", "裂缝", "开裂", "破损", "露筋", "锈蚀", "渗水", "泛碱", "变形", "缺失", "堵塞", "脱落", "沉降", "冲刷")
SPECIFIC_DEFECTS = ("裂缝", "开裂", "破损", "露筋", "锈蚀", "渗水", "泛碱", "变形", "缺失", "堵塞", "脱落", "沉降", "冲刷", "剥落", "坑槽", "积水")
CONSEQUENCES = ("影响", "降低", "削弱", "危及", "隐患", "安全", "耐久", "承载", "受力", "通行", "行车", "行人", "使用功能")
STRONG_CONSEQUENCES = ("降低", "削弱", "危及", "隐患", "安全", "耐久", "承载", "受力", "使用功能", "防护不足", "功能受限", "正常使用", "运营")
OVERALL = ("总体", "整体", "综合评定", "技术状况", "安全性评估", "承载能力", "满足要求", "符合要求", "正常使用", "安全运营")
CAUSES = ("由于", "因为", "原因", "所致")
REASSURING = ("不影响", "未影响", "满足要求", "符合要求")
MADE_UP = (
    "本次为桥梁定期检测，无往年检测评分", "不存在既有病害扩展情况", "综上，报告建议", "已有证据为", "报告未明确该类病害", "可能与构件受力、材料收缩或温度变化有关",
    "可能与长期受力、位移或老化有关", "车辆荷载长期作用、温度变化及材料老化共同影响", "混凝土保护层破损、施工密实性不足及长期环境侵蚀",
    "防排水不畅、接缝密封老化或雨水长期下渗", "可能削弱结构整体性", "影响传力状态", "若不及时处理，会影响使用功能并降低构件耐久性",
)
IMPACT = r"影响(?:结构|安全|耐久|承载|受力|通行|行车|行人|使用|功能|运营)"
PAST_WORK = r"(?:19|20)\d{2}年.*(?:检测|检查|维修|加固)"
ACTION_TAIL = r"[，,；;]\s*(?:建议|应(?:及时|进行|加强|对)|需及时|维修|修复|修补|处治|处置|加固|更换|清理|加强|养护|保养|小修|可采用|可直接用|环氧砂浆)"
ACTION_HEAD = r"^(?:建议|应(?:及时|进行|加强|对)|需及时|维修|修复|修补|处治|处置|加固|更换|清理|加强|养护|保养|小修|可采用|可直接用|环氧砂浆)"
CAUSE_PHRASE = r"(?:由于|因为|主要原因|原因(?:是|为)|所致|由.{1,80}(?:引起|导致)|受.{1,80}影响)"
COMPONENTS = ("上部结构", "下部结构", "桥面系", "总体", "整体", "桥梁")
NOTHING = ("无", "暂无", "不适用")

# Safety topics, first that a text names, and the rank of a statement.
SAFETY_TOPICS = (("承载能力", ("承载", "荷载")), ("耐久性", ("耐久",)), ("通行安全", ("行车", "通行", "行人")), ("使用功能", ("功能",)))
SAFETY_RANK = ((8, ("综合评定", "总体评定", "最终评定", "安全性评估")), (5, ("承载能力", "结构安全", "使用功能", "耐久性")), (3, ("满足要求", "符合要求", "不影响", "影响")))

# Name endings with (raw type, type, noun), first that a name has.
FACILITIES = (
    ("人行地通道", "pedestrian_underpass", "人行通道"), ("人行地道", "pedestrian_underpass", "人行通道"), ("地下通道", "pedestrian_underpass", "人行通道"),
    ("人行通道", "pedestrian_underpass", "人行通道"), ("车行下穿道", "vehicle_underpass", "车行下穿道"), ("车行地通道", "vehicle_underpass", "车行地通道"),
    ("车行通道", "vehicle_underpass", "车行通道"), ("下穿道", "vehicle_underpass", "下穿道"), ("隧道", "tunnel", "隧道"), ("涵洞", "culvert", "涵洞"), ("道路", "road", "道路"),
    ("桥式通道", "bridge", "桥式通道"), ("人行天桥", "pedestrian_overpass", "人行天桥"), ("匝道桥", "bridge", "桥梁"), ("立交桥", "bridge", "桥梁"), ("大桥", "bridge", "桥梁"),
    ("中桥", "bridge", "桥梁"), ("小桥", "bridge", "桥梁"), ("天桥", "bridge", "天桥"), ("桥", "bridge", "桥梁"), ("通道", "underpass", "通道"),
)

# Endings that a label's file name has beyond the facility's name.
LABEL_ENDINGS = ("无对比年度的信息提取报告", "无对比年度定检报告", "的信息提取报告", "信息提取报告", "定检报告", "检测报告", "报告")

# Display tails of descriptions, and item labels.
UNIT_NOTE = r"\s*[（(]\s*单位\s*[:：]?\s*[^）)]{1,16}[）)]\s*$"
FIGURE_NO = r"[0-9一二三四五六七八九十百千]+(?:[.．\-—_][0-9一二三四五六七八九十百千]+)*"
FIGURE_WORD = r"(?:照片|图片|附图|图|照)"
ITEM_LABEL = r"^\s*(?:[（(]?\d+[）).、．:]|[①②③④⑤⑥⑦⑧⑨⑩]|[一二三四五六七八九十]+[、.．])\s*"

# The sections of a record, their weights, and the fields of its rows.
SECTION_WEIGHTS = {"summary": 20.0, "detailed_conclusion": 15.0, "recommendations": 20.0, "defects": 30.0, "causes": 5.0, "treatments": 5.0, "safety_impact": 5.0}
DEFECT_FIELDS = ("location", "defect_type", "description", "is_new", "previous_status", "development")
RECOMMENDATION_FIELDS = ("category", "content", "location")

# Headers of defect tables by field; the short ones count only as the whole header.
DEFECT_HEADERS = (
    ("index", ("序号", "编号", "病害编号", "缺陷编号", "病害序号", "缺陷序号")), ("location", ("病害部位", "病害位置", "缺陷位置", "所在部位", "部位", "位置")),
    ("defect_type", ("病害类型", "病害种类", "缺陷类型", "病害名称", "缺陷名称", "类型")), ("description", ("病害描述", "缺陷描述", "具体描述", "具体位置", "病害情况", "病害特征", "病害内容", "描述")),
    ("is_new", ("是否新增", "新增情况", "是否新病害", "新旧")), ("previous_status", ("上一次定检状态", "历史状态", "上次状态", "既有病害状态", "既往状态")), ("development", ("发展程度", "发展趋势", "病害发展", "变化趋势", "发展")),
)
EXACT_HEADERS = ("序号", "编号", "部位", "位置", "类型", "描述", "具体位置", "发展", "新旧")

# What a defect is called, states that are none, and rows that hold no defect.
DEFECT_TERMS = (
    "无泄水孔及排水设施", "无泄水孔", "无排水设施", "渗水泛碱", "裂缝修补", "露筋锈蚀", "混凝土破损", "裂缝", "破损", "损坏", "渗水", "漏水", "锈蚀", "露筋", "剥落", "脱空", "堵塞", "缺失", "变形", "沉降", "错台", "老化",
    "松动", "开裂", "腐蚀", "离析", "不密实", "磨损", "泛碱", "风化", "下挠", "冲刷", "积水", "淤积", "残缺", "坑槽", "麻面", "蜂窝", "胀模", "脱落", "网裂", "车辙", "未设置", "外倾", "掏空", "坑洼", "长草", "堆积", "推积", "覆盖",
    "凸起", "突起", "外鼓", "滑痕", "刮痕", "划痕", "烟熏", "断裂", "拆除", "被拆", "高差", "变窄", "错位", "纵裂", "横裂", "斜裂", "竖裂", "漏浆", "空洞", "缺角", "积土", "积淤", "锈胀", "跳车", "龟裂", "磨光", "露骨", "坑洞", "不饱满",
    "抵死", "抵拢", "杂物", "垃圾", "杂草丛生", "模板未拆",
)
NO_DEFECT = ("无病害", "无明显病害", "未发现明显", "未发现病害", "未见明显病害", "未见病害")
FORMAL_STATES = ("修补", "现状", "加固", "碳纤维", "遮掩", "外观")
CAPTION = r"^(?:照片|照|图|附图|表)\s*[0-9一二三四五六七八九十百千]+(?:[.\-][0-9一二三四五六七八九十百千]+)*"
FIGURE = r"(?:照片|照|图|附图|表)\s*([0-9一二三四五六七八九十百千]+(?:[.\-][0-9一二三四五六七八九十百千]+)*)"
UNIT_ROW = r"^(?:单位|备注|注|说明|数量|表注)(?:[:：][^，。；;]{0,30})?$"
PLACEHOLDER = r"^(?:[-—–/…·．.]+|无|空白|空|无病害|无缺陷|未发现病害|未发现缺陷|本(?:表|页)(?:无|未发现)(?:病害|缺陷)?|以下空白|（以下空白）|本表无病害|本页无病害|无内容|暂无)$"
SIDES = ("左幅", "右幅", "左侧", "右侧")

# Structural components by the words of their parts, in the order that settles ties.
COMPONENT_TERMS = (
    ("上部结构", ("上部结构", "主梁", "梁", "板", "翼板", "腹板", "横隔", "铰缝", "索", "桥面板")), ("下部结构", ("下部结构", "桥墩", "墩", "桥台", "台帽", "台身", "盖梁", "支座", "基础", "挡块")),
    ("桥面系", ("桥面系", "桥面", "铺装", "路面", "伸缩缝", "护栏", "栏杆", "排水", "泄水", "人行道", "路缘")), ("主体结构", ("主体结构", "顶板", "侧墙", "墙体", "底板", "衬砌", "洞口", "翼墙")), ("附属设施", ("附属设施", "栏杆", "扶手", "照明", "标志", "排水")),
)
LOCATION_TOKEN = r"(?i)(?:左幅|右幅)?\d+#(?:跨|墩|台|缝|支座|梁|板)|(?:距)?\d+#(?:伸缩缝|墩|台)|K\d+(?:\+\d+)?"

# Labels of summary fields (the usual ones; callers add theirs).
SUMMARY_LABELS = (
    ("bridge_name", ("桥梁名称", "桥名", "工程名称", "设施名称", "项目名称")), ("bridge_id", ("桥梁编号", "桥梁ID")), ("report_date", ("报告日期", "出具日期", "签发日期")), ("inspection_date", ("检测日期", "检验日期", "检查日期", "检测时间")),
    ("overall_score", ("总体评分", "总体技术状况评分")), ("overall_grade", ("总体等级", "总体技术状况等级")),
)
MAY_BE_BLANK = ("bridge_id", "previous_overall_score", "previous_overall_grade")
NAME_NOISE = ("检测项目", "检测类别", "委托检测", "外观检查", "专项检测", "结构验算", "荷载试验")
