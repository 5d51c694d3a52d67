"""Explicit schemas of the tables that are read; nothing is inferred."""

SOURCE = (
    "struct<liferay_id:string,detail_page:string,pdf_links:array<string>,pdf_filenames:array<string>,file_sizes:array<string>,"
    "source_page:string,first_seen:string,last_seen:string,pending_relations:array<string>>"
)
DOC_FIELDS = (
    "type:string,title:string,entity:string,subtype:string,status:string,year:int,dept:string,refNo:string,dateIssued:string,"
    "archived:boolean,sourceCategory:string,aliases:array<string>,subjects:array<string>,attachments:int,maintenance:array<string>,"
    f"lede:string,history:string,relations:map<string,array<string>>,versions:array<struct<label:string,bucket:string,date:string>>,_source:{SOURCE}"
)
DOC = f"struct<{DOC_FIELDS}>"
DOCS = "pos bigint, slug string, " + ", ".join(p.replace(":", " ", 1) for p in [
    "type:string", "title:string", "entity:string", "subtype:string", "status:string", "year:int", "dept:string", "refNo:string", "dateIssued:string",
    "archived:boolean", "sourceCategory:string", "aliases:array<string>", "subjects:array<string>", "attachments:int", "maintenance:array<string>",
    "lede:string", "history:string", "relations:map<string,array<string>>", "versions:array<struct<label:string,bucket:string,date:string>>",
]) + f", _source {SOURCE}"
LISTING = (
    "liferay_id string, category string, title string, reference_no string, date_issued string, archived boolean, detail_page string, "
    "pdf_links array<string>, pdf_filenames array<string>, file_sizes array<string>, source_page string, scanned_at timestamp"
)
EDGE_FIELDS = (
    "action:string,level:string,unit:string,target_ref:string,anchor:string,position:string,new_ref:string,old:array<string>,new:string,"
    "news:array<string>,scope:string,path:string,confidence:string,source_line:string,is_global:boolean,paired:boolean,exception:string"
)
EDGE = f"struct<rule:string,line_no:int,{EDGE_FIELDS}>"
PARSED = f"principal string, edges array<{EDGE}>, unparsed array<string>"
EVENT = "struct<action:string,doc:string,date:string,detail:string,verified:boolean>"
PAYLOAD = (
    "slug string, title string, method string, pages int, full_text string, "
    "chunks array<struct<i:int,heading:string,attachment:string,content:string,embedded:boolean>>, "
    "pdfs array<struct<name:string,url:string,source:string>>, generated_at string"
)
