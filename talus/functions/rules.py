"""Rule tables of the engine."""

# The rule tables that results must agree with.
SENIORITY = [
    ("Intern", ["intern", "internship", "thực tập", "thực tập sinh", "fresher-intern"]),
    ("Manager", ["manager", "head of", "director", "giám đốc", "trưởng phòng", "quản lý", "trưởng bộ phận", "phó phòng"]),
    ("Lead", ["lead", "principal", "staff", "tech lead", "team lead", "team leader", "leader", "trưởng nhóm"]),
    ("Senior", ["senior", "sr", "expert", "chuyên gia", "chuyên viên cao cấp", "cao cấp"]),
    ("Junior", ["junior", "jr", "fresher", "mới tốt nghiệp", "mới ra trường", "entry"]),
]
CITIES = [
    ("Hồ Chí Minh", "South", ["ho chi minh", "hcm", "sai gon", "saigon", "tphcm", "tp hcm"]),
    ("Hà Nội", "North", ["ha noi", "hanoi"]),
    ("Đà Nẵng", "Central", ["da nang", "danang"]),
    ("Bình Dương", "South", ["binh duong"]),
    ("Đồng Nai", "South", ["dong nai"]),
    ("Cần Thơ", "South", ["can tho"]),
    ("Bắc Ninh", "North", ["bac ninh"]),
    ("Hưng Yên", "North", ["hung yen"]),
    ("Hải Phòng", "North", ["hai phong"]),
    ("Bắc Giang", "North", ["bac giang"]),
    ("Vĩnh Phúc", "North", ["vinh phuc"]),
    ("Quảng Nam", "Central", ["quang nam"]),
    ("Khánh Hòa", "Central", ["khanh hoa", "nha trang"]),
    ("Huế", "Central", ["hue", "thua thien"]),
]
REMOTE = ["remote", "tu xa", "work from home", "wfh", "hybrid"]
LANGUAGES = [
    ("EN", ["tieng anh", "english", "toeic", "ielts"]),
    ("JP", ["tieng nhat", "japanese", "jlpt", "n1", "n2", "n3"]),
    ("KO", ["tieng han", "korean", "topik"]),
]
LEGAL = [
    "công ty", "cong ty", "cổ phần", "co phan", "tnhh", "jsc", "ltd", r"co\.?,?\s*ltd", "corporation", "corp", "inc",
    "company", "việt nam", "viet nam", "vietnam", "group", "tập đoàn", "tap doan", "mtv", "một thành viên",
]
