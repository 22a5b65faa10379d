"""Fixed values of the phone catalogue profile: field names, tables, and patterns of the data contract.

Fixed values: these must equal the published data's for right results; they are data, in their natural order.
Operators take the tables as parameters, with these as defaults.
"""

#: Fixed values, from here to the end of the file.
FIXED_FIELDS = [
    '数据来源',
    '验证状态',
    '交叉验证差异',
    '品牌',
    '型号',
    '手机ID',
    '上市时间',
    '价格',
    '机身宽度',
    '机身尺寸',
    '摄像头参数',
    '超广角缩放倍数',
]

VALIDATION_FIELDS = ('处理器', '内存', '存储', '屏幕', '电池', '摄像头参数', '上市时间')
VALIDATION_MISSING = {'', '-', '--', '/', 'n/a', 'null', '暂无', '无', '未知'}

AUDITED_ALIASES = {
    '定位系统': '定位导航',
    'WiFi(WLAN)': 'WLAN功能',
    'NFC功能': 'NFC',
    '机身颜色': '手机颜色',
}

HEADER_MAP = {
    '国内发布时间': '上市时间',
    '发布时间': '上市时间',
    '发布日期': '上市时间',
    '上市日期': '上市时间',
    '电商报价': '价格',
    '售价': '价格',
    '报价': '价格',
    '手机名称': '型号',
    'name': '型号',
    '产品名称': '型号',
    'CPU型号': '处理器',
    'CPU': '处理器',
    'CPU品牌': '处理器',
    '处理器型号': '处理器',
    '处理器': '处理器',
    '屏幕尺寸': '屏幕',
    '主屏尺寸': '屏幕',
    '屏幕': '屏幕',
    '屏幕大小': '屏幕',
    '屏幕类型': '屏幕',
    '分辨率': '屏幕分辨率',
    '主屏分辨率': '屏幕分辨率',
    '屏幕分辨率': '屏幕分辨率',
    '后置摄像头': '摄像头参数',
    '后置相机': '摄像头参数',
    '后置摄像头像素': '摄像头参数',
    '前置摄像头': '摄像头参数',
    '前置相机': '摄像头参数',
    '前置摄像头像素': '摄像头参数',
    '摄像头名称': '摄像头参数',
    '摄像头总数': '摄像头参数',
    '摄像头特色': '摄像头参数',
    '变焦倍数': '摄像头参数',
    '传感器尺寸': '摄像头参数',
    '镜头片数': '摄像头参数',
    '焦距': '摄像头参数',
    '其他摄像头参数': '摄像头参数',
    '电池容量': '电池',
    '电池容量(mAh)': '电池',
    '电池': '电池',
    '电池类型': '电池',
    'RAM容量': '内存',
    '运行内存': '内存',
    '运行内存(RAM)': '内存',
    '内存': '内存',
    '运存类型': '内存',
    'RAM存储类型': '内存',
    'ROM容量': '存储',
    '机身存储': '存储',
    '机身容量': '存储',
    '存储': '存储',
    'ROM存储类型': '存储',
    '存储类型': '存储',
    '存储卡': '存储',
    '扩展卡': '存储',
    '扩展容量': '存储',
    '机身尺寸': '机身尺寸',
    '尺寸': '机身尺寸',
    '长度': '机身长度',
    '宽度': '机身宽度',
    '厚度': '机身厚度',
    '重量': '机身重量',
    '机身重量': '机身重量',
    **AUDITED_ALIASES,
}

BRAND_ALIASES = {
    '步步高': 'vivo',
    'vivo': 'vivo',
    '红米': '红米',
    'redmi': '红米',
    '小米': '小米',
    'xiaomi': '小米',
    'poco': '小米',
    'oppo': 'OPPO',
    'OPPO': 'OPPO',
    '一加': '一加',
    'oneplus': '一加',
    '真我': '真我',
    'realme': '真我',
    'iqoo': 'iQOO',
    'iQOO': 'iQOO',
    '华为': '华为',
    'huawei': '华为',
    '荣耀': '荣耀',
    'honor': '荣耀',
    '三星': '三星',
    'samsung': '三星',
    '苹果': '苹果',
    'apple': '苹果',
    'iphone': '苹果',
    'ipad': '苹果',
    '魅族': '魅族',
    'meizu': '魅族',
    '中兴': '中兴',
    'zte': '中兴',
    '努比亚': '努比亚',
    'nubia': '努比亚',
    '联想': '联想',
    'lenovo': '联想',
    '摩托罗拉': '摩托罗拉',
    'moto': '摩托罗拉',
    'motorola': '摩托罗拉',
    '索尼': '索尼',
    'sony': '索尼',
    'xperia': '索尼',
    '谷歌': '谷歌',
    'google': '谷歌',
    'pixel': '谷歌',
    '诺基亚': '诺基亚',
    'nokia': '诺基亚',
    'nothing': 'Nothing',
    '传音': '传音',
    'tecno': '传音',
    'itel': '传音',
    'infinix': '传音',
    '乐视': '乐视',
    'letv': '乐视',
    '金立': '金立',
    'gionee': '金立',
    '蔚来': '蔚来',
    'nio': '蔚来',
    '鼎桥': '鼎桥',
    'td tech': '鼎桥',
    '魅蓝': '魅蓝',
    '酷派': '酷派',
    'coolpad': '酷派',
    '海信': '海信',
    'hisense': '海信',
    'wiko': 'WIKO',
    '麦芒': '麦芒',
    '华硕': '华硕',
    'asus': '华硕',
    'rog': '华硕',
    '黑鲨': '黑鲨',
    'black shark': '黑鲨',
    'nzone': 'NZONE',
    'lg': 'LG',
}

ALLOWED_BRANDS = {
    '苹果', '三星', '华为', '荣耀', 'OPPO', 'vivo', '小米', '红米', 'iQOO',
    '一加', '真我', '魅族', '中兴', '努比亚', '联想', '摩托罗拉',
    '乐视', '金立', '蔚来', '鼎桥', '魅蓝', '酷派', '海信', 'WIKO',
    '麦芒', '华硕', '黑鲨', 'NZONE', 'Hi nova', '天翼铂顿',
}

BRAND_PATTERNS = [
    ('苹果', ['iphone', 'ipad', 'apple']),
    ('华为', ['huawei', '华为']),
    ('荣耀', ['honor', '荣耀']),
    ('小米', ['xiaomi', '小米', 'poco']),
    ('红米', ['redmi', '红米']),
    ('OPPO', ['oppo']),
    ('一加', ['oneplus', '一加']),
    ('真我', ['realme', '真我']),
    ('vivo', ['vivo']),
    ('iQOO', ['iqoo']),
    ('三星', ['samsung', '三星']),
    ('魅族', ['meizu', '魅族']),
    ('中兴', ['zte', '中兴']),
    ('努比亚', ['nubia', '努比亚']),
    ('联想', ['lenovo', '联想']),
    ('摩托罗拉', ['moto', 'motorola', '摩托罗拉']),
    ('索尼', ['sony', '索尼', 'xperia']),
    ('谷歌', ['google', 'pixel']),
    ('诺基亚', ['nokia', '诺基亚']),
    ('Nothing', ['nothing']),
    ('传音', ['tecno', 'itel', 'infinix']),
    ('乐视', ['乐视', 'letv']),
    ('金立', ['金立', 'gionee']),
    ('蔚来', ['蔚来', 'nio phone']),
    ('鼎桥', ['鼎桥', 'td tech']),
    ('魅蓝', ['魅蓝']),
    ('酷派', ['酷派', 'coolpad', 'cool ']),
    ('海信', ['海信', 'hisense']),
    ('WIKO', ['wiko', 'hi 畅享', 'hi畅享']),
    ('麦芒', ['麦芒']),
    ('Hi nova', ['hi nova', 'hinova']),
    ('天翼铂顿', ['天翼铂顿']),
    ('华硕', ['华硕', 'asus', 'rog游戏手机', 'rog game']),
    ('黑鲨', ['黑鲨', 'black shark']),
    ('NZONE', ['nzone']),
    ('LG', ['lg ']),
]

#: Keys of a raw record that are identity or crawl metadata, not fields.
TECHNICAL_KEYS = ["id", "name", "url", "crawl_time", "param_url", "phone_id", "brand"]
DATE_KEYS = ["上市时间", "国内发布时间", "发布时间", "发布日期", "上市日期"]
NEGATIVE_VALUES = ["无", "不支持", "否", "没有", "未配备", "不提供", "0", "0.0"]
CAPACITY_FIELDS = ["内存", "存储"]

#: Applied in order, (pattern, replacement).
RESIDUE = [
    (r"•[^•|]{1,24}是什么•查看所有[^•|]*", ""),
    (r"更多[^>|]{1,30}手机>", ""),
    (r"手机性能排行>", ""),
    (r"(?:，|,)?[^>|]{0,12}排行>", ""),
    (r"手机>", ""),
    (r">\s*[|｜]", "|"),
    (r"[，,、]\s*[|｜]", "|"),
]
SPEC_COPY = {
    "内存": [(r"游戏运行(?:流畅|良好|一般)", "")],
    "存储": [(r"(?:约)?\d+(?:\.\d+)?\s*万?\s*张照片", ""), (r"(?:约)?\d+(?:\.\d+)?\s*万?\s*首歌曲", ""), ("无扩展卡功能", "不支持容量扩展")],
}
SPEC_EMPTY_BRACKETS = r"[（(]\s*[、,，/|•>；;]*\s*[）)]"
SPEC_SEPARATORS = r"\s*[、,，/|•>；;]+\s*"

KEY_CAPACITY_BRACKET = r"[（(](?:\d+\s*(?:[gt]b)?\s*[+/]+\s*\d+\s*[gt]b?|\d+\s*[gt]b?)(?:\s*/\s*(?:全网通|[45]g版|wifi版))*[)）]"
KEY_CAPACITY_TAIL = r"(?<![a-z0-9])(?:\d+\s*(?:[gt]b)?\s*[+/]+\s*\d+\s*[gt]b?|\d+\s*[gt]b)$"
KEY_MARKETING = (
    r"[（(](?:双卫星版?|高定款|高定版|钛金属特别版|钛金属版|特别版|限量版|"
    r"冠军版|联名版|典藏版|礼盒版?|套装版|尊享版|臻享版|优享版|青春版|活力版|嘉年华版|lite版)[）)]"
)
KEY_BRANDS = {
    "华为": "huawei", "荣耀": "honor", "小米": "xiaomi", "红米": "redmi",
    "一加": "oneplus", "真我": "realme", "三星": "samsung", "苹果": "apple",
    "努比亚": "nubia", "摩托罗拉": "motorola", "魅族": "meizu",
    "联想": "lenovo", "索尼": "sony", "谷歌": "google", "中兴": "zte",
    "华硕": "asus", "诺基亚": "nokia", "夏普": "sharp",
    "步步高": "vivo", "vivo": "vivo", "oppo": "oppo", "iqoo": "iqoo", "poco": "xiaomi",
}
KEY_DESIGN = (r"(rsr)保时捷设计$", "$1")
KEY_SUFFIXES = ["5g版", "4g版", "5g", "4g", "wifi版", "全网通", "wifi"]

CAMERA_PARTS = [
    ("后置", "后置摄像头像素"), ("前置", "前置摄像头像素"), ("镜头", "摄像头名称"), ("数量", "摄像头总数"), ("变焦", "变焦倍数"), ("传感器", "传感器尺寸"),
    ("焦距", "焦距"), ("特色", "摄像头特色"), ("视频", "后置视频拍摄"), ("前置视频", "前置视频拍摄"), ("其他", "其他摄像头参数"),
]
ULTRAWIDE_KEYS = ["摄像头名称", "变焦倍数", "焦距", "其他摄像头参数", "摄像头参数"]
ULTRAWIDE = [r"超广角.{0,24}?((?:0\.\d+|1(?:\.0+)?)\s*(?:x|X|倍))", r"((?:0\.\d+|1(?:\.0+)?)\s*(?:x|X|倍)).{0,24}?超广角"]

SCREEN_MATERIAL = r"AMOLED|OLED|LCD|IPS"
PROCESSOR_CORE = r"(骁龙\s*8\s*(?:Elite|Gen\d+)|骁龙|天玑\s*\d+\w*|麒麟\s*\d+\w*|Exynos\s*\d+|Tensor|Apple\s*A\d+|Helio\s*\w+)"
STATUS = {"single": "单源", "unverified": "多源未校验", "two_same": "双源一致", "two_differ": "双源差异", "three_same": "三源一致", "three_differ": "三源差异"}
TOO_MANY_SOURCES = "来源数量超过三源判定范围"
MISSING_WORD = "缺失"
SOURCES = ["中关村在线", "太平洋电脑网", "CNMO"]
