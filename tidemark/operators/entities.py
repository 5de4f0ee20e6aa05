"""Entity rows out of nested API payloads, and their fan-out into tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

PROJECT = (
    "projectId string, projectNumber string, mfn string, secondaryNumber string, createdDate string, status string, dateOfLoss string, typeOfLoss string, causeOfLoss string, "
    "lossDescription string, yearBuilt string, squareFootage string, dateReceived string, dateContacted string, plannedInspectionDate string, dateInspected string, appointmentDate string, "
    "customAttribute1 string, customAttribute2 string, customAttribute3 string, customExternalUniqueId string, "
    "customerInformation struct<firstName string, lastName string, customBusinessName string, businessLineType string, "
    "emails array<struct<emailAddress string, primary boolean>>, phones array<struct<phoneNumber string, phoneCountryCode string>>>, "
    "address struct<street1 string, street2 string, city string, stateProvince string, zipPostcode string, county string, country string>"
)
PROJECT_PAYLOAD = f"project struct<{PROJECT}>, companyName string, teamMembers array<struct<userName string, primaryContact string, mfn string>>"


def parsed_projects(df: DataFrame, payload: str = "payload") -> DataFrame:
    """df with p, the parsed project response, which may be wrapped in `data`; null where it is not JSON."""
    both = F.from_json(payload, f"data struct<{PROJECT_PAYLOAD}>, {PROJECT_PAYLOAD}")
    bare = F.when(F.col("__p").isNotNull(), F.struct("__p.project", "__p.companyName", "__p.teamMembers"))
    return df.withColumn("__p", both).withColumn("p", F.coalesce("__p.data", bare)).drop("__p")


def primary(items: Column, flag: str, field: str) -> Column:
    """The field of the first item that bears the flag, else of the first item."""
    chosen = F.try_element_at(F.filter(items, lambda x: F.coalesce(x[flag], F.lit(False))), F.lit(1))
    return F.coalesce(text.clean(chosen[field]), text.clean(F.try_element_at(items, F.lit(1))[field]))


def project_rows(df: DataFrame) -> DataFrame:
    """One row for each parsed project response (columns p, event_id)."""
    pr, customer, address = F.col("p.project"), F.col("p.project.customerInformation"), F.col("p.project.address")
    phone = F.try_element_at(customer["phones"], F.lit(1))
    plain = {"project_id": "projectId", "project_number": "projectNumber", "master_file_name": "mfn", "secondary_number": "secondaryNumber", "status": "status", "type_of_loss": "typeOfLoss", "cause_of_loss": "causeOfLoss", "loss_description": "lossDescription", "custom_attribute1": "customAttribute1", "custom_attribute2": "customAttribute2", "custom_attribute3": "customAttribute3", "custom_external_unique_id": "customExternalUniqueId"}
    times = {"created_date": "createdDate", "date_of_loss": "dateOfLoss", "date_received": "dateReceived", "date_contacted": "dateContacted", "planned_inspection_date": "plannedInspectionDate", "date_inspected": "dateInspected", "appointment_date": "appointmentDate"}
    of_customer = {"customer_first_name": "firstName", "customer_last_name": "lastName", "custom_business_name": "customBusinessName", "business_line_type": "businessLineType"}
    of_address = {"street1": "street1", "street2": "street2", "city": "city", "state_province": "stateProvince", "zip_postcode": "zipPostcode", "county": "county", "country": "country"}
    return df.where(F.col("p").isNotNull()).select(
        *[text.clean(pr[v]).alias(k) for k, v in plain.items()],
        *[text.iso_timestamp(pr[v]).alias(k) for k, v in times.items()],
        *[text.clean(customer[v]).alias(k) for k, v in of_customer.items()],
        *[text.clean(address[v]).alias(k) for k, v in of_address.items()],
        text.try_int(pr["yearBuilt"]).alias("year_built"), text.try_int(pr["squareFootage"]).alias("square_footage"),
        primary(customer["emails"], "primary", "emailAddress").alias("primary_email"),
        text.clean(phone["phoneNumber"]).alias("primary_phone"), text.try_int(phone["phoneCountryCode"]).alias("primary_phone_country_code"),
        text.clean(F.col("p.companyName")).alias("company_name"), "event_id",
    )


def contact_rows(df: DataFrame) -> DataFrame:
    """The policyholder (if there is an email) and one claim representative for each named team member, in one pass."""
    customer = F.col("p.project.customerInformation")
    phone = F.try_element_at(customer["phones"], F.lit(1))
    none = F.lit(None).cast("string")

    def contact(email: Column, kind: str, first: Column, last: Column, number: Column, is_primary: Column, file: Column) -> Column:
        return F.struct(email.alias("contact_email"), F.lit(kind).alias("contact_type"), first.alias("first_name"), last.alias("last_name"), number.alias("phone_number"), is_primary.alias("is_primary_contact"), file.alias("master_file_name"))

    holder = contact(primary(customer["emails"], "primary", "emailAddress"), "POLICYHOLDER", text.clean(customer["firstName"]), text.clean(customer["lastName"]), text.clean(phone["phoneNumber"]), F.lit(True), none)
    members = F.transform("p.teamMembers", lambda m: contact(text.clean(m["userName"]), "CLAIM_REP", none, none, none, F.coalesce(text.loose_bool(m["primaryContact"]), F.lit(False)), text.clean(m["mfn"])))
    every = F.when(F.col("p.teamMembers").isNull(), F.array(holder)).otherwise(F.concat(F.array(holder), members))
    project = text.clean(F.col("p.project.projectId")).alias("project_id")
    return df.select(project, "event_id", F.inline(every)).where(F.col("contact_email").isNotNull())


#: Column -> (JSON key, kind) of flat entities; kinds: text, id, int, bool, time, decimal. Fixed values.
TASK = {"assignment_id": ("assignmentId", "int"), "task_id": ("taskId", "int"), "task_name": ("taskName", "text"), "form_id": ("formId", "text"), "project_id": ("projectId", "id"), "assignee_id": ("assigneeId", "int"), "assignor_id": ("assignorId", "int"), "assignor_email": ("assignor", "text"), "date_assigned": ("dateAssigned", "time"), "date_completed": ("dateCompleted", "time"), "cancelled_date": ("cancelledDate", "time"), "status": ("status", "text"), "stp_enabled": ("stpEnabled", "bool"), "mfn": ("mfn", "text"), "task_url": ("url", "text")}
TEMPLATE = {"task_id": ("taskId", "int"), "comp_id": ("compId", "int"), "name": ("name", "text"), "description": ("description", "text"), "form_id": ("formId", "text"), "form_name": ("formName", "text"), "enabled": ("enabled", "bool"), "is_default": ("default", "bool"), "is_manual_delivery": ("isManualDelivery", "bool"), "allow_resubmit": ("allowReSubmit", "bool"), "modified_by": ("modifiedBy", "text"), "modified_by_id": ("modifiedById", "int"), "modified_date": ("modifiedDate", "time")}
LINK = {"link_id": ("linkId", "int"), "link_code": ("linkCode", "text"), "url": ("url", "text"), "notification_access_method": ("notificationAccessMethod", "text"), "country_id": ("countryId", "int"), "state_id": ("stateId", "int")}
MEDIA = {"media_id": ("mediaID", "id"), "task_assignment_id": ("taskAssignmentId", "text"), "file_type": ("mediaType", "text"), "file_name": ("mediaName", "text"), "media_description": ("mediaDescription", "text"), "media_comment": ("mediaComment", "text"), "latitude": ("latitude", "text"), "longitude": ("longitude", "text"), "gps_source": ("gpsSource", "text"), "taken_date": ("takenDate", "text"), "full_download_link": ("fullDownloadLink", "text"), "expires_at": ("expiresAt", "text")}
VIDEO = {"video_collaboration_id": ("videoCollaborationId", "int"), "claim_id": ("claimId", "int"), "mfn": ("mfn", "text"), "claim_number": ("claimNumber", "text"), "policy_number": ("policyNumber", "text"), "email_user_name": ("emailUserName", "text"), "claim_rep_first_name": ("claimRepFirstName", "text"), "claim_rep_last_name": ("claimRepLastName", "text"), "number_of_videos": ("numberOfVideos", "int"), "number_of_photos": ("numberOfPhotos", "int"), "session_count": ("sessionCount", "int"), "total_time_seconds": ("totalTimeSeconds", "decimal"), "total_time": ("totalTime", "text"), "created_date": ("createdDate", "time"), "company_id": ("companyId", "int"), "company_name": ("companyName", "text"), "guid": ("guid", "text")}
_KINDS = {"text": text.clean, "id": text.id_text, "int": text.try_int, "bool": text.loose_bool, "time": text.iso_timestamp, "decimal": text.decimal_text}


def flat_rows(df: DataFrame, payload: Column, fields: dict, *keep: str) -> DataFrame:
    """Typed columns out of a flat JSON object, beside the kept columns."""
    return df.select(*[_KINDS[kind](text.json_field(payload, key)).alias(name) for name, (key, kind) in fields.items()], *keep)


def video_rows(df: DataFrame, payload: Column, *keep: str) -> DataFrame:
    """Video collaborations; the full name is put together where it is absent, the id may be named id."""
    out = flat_rows(df.withColumn("__p", payload), F.col("__p"), VIDEO, *keep, "__p")
    full = F.coalesce(text.clean(text.json_field(F.col("__p"), "claimRepFullName")), text.clean(F.concat_ws(" ", "claim_rep_first_name", "claim_rep_last_name")))
    ident = F.coalesce("video_collaboration_id", text.try_int(text.json_field(F.col("__p"), "id")))
    return out.withColumn("claim_rep_full_name", full).withColumn("video_collaboration_id", ident).drop("__p")


def link_contacts(links: DataFrame, payload: Column, *keep: str) -> DataFrame:
    """Contacts of external links that have an email."""
    return links.select(text.clean(text.json_field(payload, "email")).alias("contact_email"), *keep).where(F.col("contact_email").isNotNull())


def matching(items: Column, field: str, value: Column) -> Column:
    """The first item whose field equals value, else the first."""
    return F.coalesce(F.try_element_at(F.filter(items, lambda x: x[field].cast("string") == value.cast("string")), F.lit(1)), F.try_element_at(items, F.lit(1)))


def normalised_list(payload: Column, element: str, *names: str) -> Column:
    """The items of a response that is a list, or holds it under `data` or a named key, or is a single item."""
    kind = f"array<{element}>"
    held = F.coalesce(*[F.when(F.substring(F.trim(t), 1, 1) == "[", t) for t in (payload, *[text.json_field(payload, n) for n in ("data", *names)])])
    single = F.when(held.isNull() & (F.substring(F.trim(payload), 1, 1) == "{"), F.concat(F.lit("["), payload, F.lit("]")))
    return F.from_json(F.coalesce(held, single), kind)


def overlaid(rows: DataFrame, other: DataFrame, keys: list[str], column: str) -> DataFrame:
    """rows with a column taken from other where other has it."""
    small = other.select(*keys, F.col(column).alias("__new")).dropDuplicates(keys)
    return rows.join(small, keys, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def attached(events: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Events with their items; lookup_status says whether one was found."""
    return events.join(items.withColumn("__found", F.lit(True)), key, "left").withColumn("lookup_status", F.when(F.col("__found"), "found").otherwise("failed_permanent")).drop("__found")


def bundles(df: DataFrame, key: str, lists: list[str]) -> DataFrame:
    """Lists of each key concatenated over its rows; for keys with few rows, such as the events of one message batch."""
    return df.groupBy(key).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in lists])


def bundle_sizes(df: DataFrame, key: str, lists: list[str]) -> DataFrame:
    """How long the concatenated lists of each key would be, and their sum; nothing is gathered."""
    sizes = [F.sum(F.size(c)).alias(f"n_{c}") for c in lists]
    return df.groupBy(key).agg(*sizes).withColumn("n_all", sum((F.col(f"n_{c}") for c in lists), F.lit(0)))


def stamped(df: DataFrame, kind: str, at: str, stamps: dict[str, str]) -> DataFrame:
    """df with a timestamp column for each event type: the event's time in rows of that type, else null."""
    return df.withColumns({column: F.when(F.col(kind) == event, F.col(at)) for event, column in stamps.items()})


def link_failures(df: DataFrame, kind: str, failed: str, project: str) -> DataFrame:
    """A project row for each event that says that linking failed."""
    return df.where(F.col(kind) == failed).select(F.col(project).alias("project_id"), F.lit(True).alias("auto_link_failed"), "event_id")


def download_tasks(media: DataFrame, link: str = "full_download_link") -> DataFrame:
    """Media rows that have a link, as tasks with their path in the store."""
    from ..functions import urls

    named = F.concat_ws(".", urls.file_name(F.col(link)), F.nullif(F.lower(urls.file_type(F.col(link))), F.lit("unknown")))
    return media.where(F.coalesce(F.col(link), F.lit("")) != "").select("media_id", F.col(link).alias("url"), urls.media_path(F.col("project_id"), F.coalesce("file_name", named)).alias("blob_path"), F.lit(0).alias("retry_count"))
