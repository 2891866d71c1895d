"""Labels that stored rows carry. They have to match byte for byte."""

STATUS_CREATED = "נוצר במכלול"
STATUS_DOCUMENTED = "מיובא ומתועד"
STATUS_UNDOCUMENTED = "מיובא ללא תיעוד"
STATUS_EXTERNAL_1 = 'ייבוא מחב"דפדיה'
STATUS_EXTERNAL_2 = "ייבוא מוויקישיבה"
STATUS_KEPT = "נשמר במכלול למרות מחיקה בוויקיפדיה"
STATUS_SPLIT = "פוצל מתוכן ויקיפדי"

MATCH_IMPORTED = "יובא מוויקיפדיה"
MATCH_UNRELATED = "כותרת זהה ללא קשר"
MATCH_NONE = "ללא התאמה"

METHOD_MANUAL = "התאמה_ידנית"
METHOD_HYGIENE = "היגיינת_טקסט"
METHOD_TEMPLATE = "תבנית_מיון"

TASK_DELETED = "לבדוק מחיקה/השוואה לוויקיפדיה"
TASK_STATUS = "סטטוס לא ברור"

REASON_CREATE_LOCK = "נעול ליצירה במכלול (allevel=create) - זוהה אוטומטית"
REASON_READ_LOCK = "נעול לקריאה במכלול (allevel=read) - זוהה אוטומטית"

MONTHS = ("ינואר", "פברואר", "מרץ", "אפריל", "מאי", "יוני", "יולי", "אוגוסט", "ספטמבר", "אוקטובר", "נובמבר", "דצמבר")

# groups that the cascade and the constraints use
STATUSES = (STATUS_CREATED, STATUS_DOCUMENTED, STATUS_UNDOCUMENTED, STATUS_EXTERNAL_1, STATUS_EXTERNAL_2, STATUS_KEPT, STATUS_SPLIT)
MATCH_TYPES = (MATCH_IMPORTED, MATCH_UNRELATED, MATCH_NONE)
NOT_IMPORTED = (STATUS_CREATED, STATUS_EXTERNAL_1, STATUS_EXTERNAL_2, STATUS_SPLIT)
MATCH_NOT_EXPECTED = (*NOT_IMPORTED, STATUS_KEPT)
