"""Marts over the conformed tables, as DataFrames.

String aggregates are sorted, ties are broken by the whole row and the run's timestamp is a
parameter, so a mart depends on its inputs alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltlake.functions.exprs import active, distinct_list, nonblank, ordered_list
from siltlake.operators.windows import nearest_preceding, top_per_key

RESOLVED = ("Closed", "Resolved", "7", "6")
FEEDBACK = ("helpful", "not helpful")


def text(value: Column, default: str = "") -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def topics(interactions: DataFrame) -> DataFrame:
    entity = F.trim("detail_entity")
    rows = interactions.where(active() & nonblank(F.col("detail_entity")) & (F.lower(entity) != "nan"))
    return rows.groupBy("conversation_id").agg(distinct_list(entity).alias("conversation_topic"))


def bot_replies(interactions: DataFrame) -> DataFrame:
    """The first reply to each interaction, by id."""
    rows = interactions.where(active() & (F.lower("actor") == "bot") & F.col("parent_interaction_id").isNotNull() & nonblank(F.col("detail_content")))
    return top_per_key(rows, ["parent_interaction_id"], [F.col("id").asc(), F.col("detail_content").asc()]).select("parent_interaction_id", F.col("detail_content").alias("bot_response"))


def plugins(calls: DataFrame) -> DataFrame:
    served, used = F.col("served").try_cast("boolean"), F.col("used").try_cast("boolean")
    rows = calls.where(active() & F.col("interaction_id").isNotNull() & nonblank(F.col("plugin_name")))
    only = lambda when: distinct_list(F.when(when, F.col("plugin_name")))
    return rows.groupBy("interaction_id").agg(
        only(~F.coalesce(served, F.lit(False)) & ~F.coalesce(used, F.lit(False))).alias("unsuccessful_plugins"),
        only(served).alias("plugin_served"), only(served & used).alias("plugin_used"),
    )


def resources(rows: DataFrame) -> DataFrame:
    ticket = F.col("type") == "RESOURCE_TYPE_TICKET"
    given = lambda c, when=F.lit(True): distinct_list(F.when(when & nonblank(F.col(c)), F.col(c)))
    return rows.where(active() & F.col("interaction_id").isNotNull()).groupBy("interaction_id").agg(
        given("detail_domain").alias("resource_domain"), F.count_distinct("resource_id").alias("no_of_citations"), given("detail_name").alias("content_item_name"),
        given("detail_external_resource_id").alias("content_item_id"), F.max(F.when(ticket, "user initiated ticket")).alias("ticket_type"), given("detail_external_resource_id", ticket).alias("ticket_id"),
    )


def latest_users(users: DataFrame) -> DataFrame:
    rows = users.where(active() & nonblank(F.col("id")))
    return top_per_key(rows, ["id"], [F.coalesce("_updated_at", "_inserted_at").desc(), F.col("user_preferred_language").desc()]).select(F.col("id").alias("u_id"), "user_preferred_language")


def interactions(interactions: DataFrame, conversations: DataFrame, calls: DataFrame, used: DataFrame, users: DataFrame, run_at: Column) -> DataFrame:
    """One row per user interaction, with its conversation, topics, first reply, plug-ins, resources and user."""
    domains = conversations.where(active()).select("conversation_id", "primary_domain")
    rows = interactions.where(active() & (F.lower("actor") == "user"))
    met = (
        rows.join(domains, "conversation_id", "left").join(topics(interactions), "conversation_id", "left")
        .join(bot_replies(interactions).withColumnRenamed("parent_interaction_id", "r_id"), F.col("id") == F.col("r_id"), "left")
        .join(plugins(calls).withColumnRenamed("interaction_id", "p_id"), F.col("id") == F.col("p_id"), "left")
        .join(resources(used).withColumnRenamed("interaction_id", "c_id"), F.col("id") == F.col("c_id"), "left")
        .join(latest_users(users), F.col("user_id") == F.col("u_id"), "left")
    )
    plain = ["unsuccessful_plugins", "plugin_served", "plugin_used", "resource_domain", "content_item_name", "content_item_id", "ticket_type", "ticket_id", "user_preferred_language"]
    return met.select(
        F.col("created_time").cast("string").alias("timestamp"), F.col("conversation_id").cast("string").alias("conversation_id"), F.col("id").cast("string").alias("interaction_id"),
        text(F.col("type"), "UNKNOWN").alias("interaction_type"), text(F.col("primary_domain")).alias("conversation_domain"),
        text(F.col("conversation_topic")).alias("conversation_topic"), text(F.col("conversation_topic")).alias("conversation_topics"),
        text(F.col("detail_content")).alias("interaction_content"), text(F.col("bot_response")).alias("bot_response"), text(F.col("no_of_citations"), "0").alias("no_of_citations"),
        text(F.col("platform")).alias("interaction_surface"), *[text(F.col(c)).alias(c) for c in plain],
        *[F.lit(None).cast("string").alias(c) for c in ("user_department", "user_location", "user_country")], run_at.alias("_data_as_of"),
    )


def numbered(rows: DataFrame, value: str, label: str) -> DataFrame:
    """Non-blank values of a conversation, numbered in order of time and joined."""
    w = Window.partitionBy("conversation_id").orderBy("timestamp", "interaction_id")
    found = rows.where(nonblank(F.col("conversation_id")) & nonblank(F.col(value))).withColumn("n", F.row_number().over(w))
    return found.groupBy("conversation_id").agg(ordered_list(F.col("n"), F.concat(F.lit(f"{label} "), F.col("n").cast("string"), F.lit(": "), F.trim(value))).alias(value))


def conversations(rows: DataFrame, run_at: Column) -> DataFrame:
    """One row per conversation of the interactions mart, with what was said and whether it went to an agent."""
    live = F.when(F.lower(text(F.col("plugin_used"))).like("%start live agent chat%"), 1).otherwise(0)
    bounds = rows.where(nonblank(F.col("conversation_id"))).groupBy("conversation_id").agg(F.min("timestamp").alias("conversation_start"), F.max("timestamp").alias("conversation_end"), F.max(live).alias("escalated"))
    met = bounds.join(numbered(rows, "interaction_content", "Prompt"), "conversation_id", "left").join(numbered(rows, "bot_response", "Response"), "conversation_id", "left")
    said, heard = F.lower(text(F.col("bot_response"))), F.lower(text(F.col("interaction_content")))
    agent = F.when(F.col("escalated") != 1, "").when(said.like("%hr%"), "HR").when(said.like("%live%"), "IT").when(heard.like("%it%"), "IT").otherwise("HR")
    return met.select("conversation_id", "conversation_start", "conversation_end", text(F.col("interaction_content")).alias("interaction_content"), text(F.col("bot_response")).alias("bot_response"), F.col("escalated").cast("string").alias("escalated"), agent.alias("hr_vs_it_agent"), run_at.alias("_data_as_of"))


def feedbacks(rows: DataFrame, run_at: Column) -> DataFrame:
    """One row per rating click: the last reply before it, what it answered, and a comment typed right after."""
    clicked, content = F.lower(text(F.col("interaction_type"))), F.lower(F.trim(text(F.col("interaction_content"))))
    marked = rows.withColumn("is_feedback", (clicked == "link_click") & content.isin(*FEEDBACK))
    w = Window.partitionBy("conversation_id").orderBy("timestamp", "interaction_id")
    after = lambda c: F.lead(c).over(w)
    marked = marked.withColumns({"next_type": after(clicked), "next_content": after(F.trim(text(F.col("interaction_content")))), "next_reply": after(F.trim(text(F.col("bot_response"))))})
    near = nearest_preceding(marked, ["conversation_id"], ["timestamp", "interaction_id"], ~F.col("is_feedback") & nonblank(F.col("bot_response")), {"what_user_said": F.col("interaction_content"), "what_bot_said": F.col("bot_response")})
    comment = F.when((F.col("next_type") != "link_click") & (F.col("next_reply") == "") & (F.col("next_content") != "") & ~F.lower("next_content").isin(*FEEDBACK), F.col("next_content"))
    rated = F.lower(F.trim("interaction_content"))
    rating = F.when(rated == "helpful", "Helpful").when(rated == "not helpful", "Not Helpful").otherwise(F.col("interaction_content"))
    return near.where("is_feedback").select(F.col("interaction_id").alias("feedback_id"), "conversation_id", F.col("timestamp").cast("string").alias("timestamp"), text(F.col("what_user_said")).alias("what_user_said"), text(F.col("what_bot_said")).alias("what_bot_said"), rating.alias("rating"), text(comment).alias("feedback_text"), run_at.alias("_data_as_of"))


def incident_kpi(incidents: DataFrame, run_at: Column) -> DataFrame:
    """Incidents by priority, state and category; a null state is neither resolved nor open."""
    done = F.col("incident_state").isin(*RESOLVED)
    n = lambda when: F.sum(F.when(when, 1).otherwise(0)).cast("string")
    groups = [F.coalesce("priority", F.lit("Unassigned")).alias("priority_level"), F.coalesce("incident_state", F.lit("Unknown")).alias("incident_state_"), F.coalesce("category", F.lit("General")).alias("incident_category")]
    return incidents.groupBy(*groups).agg(
        F.count_distinct("sys_id").cast("string").alias("total_incidents"), n(F.col("_is_deleted") == "Y").alias("soft_deleted_incidents"), n(done).alias("resolved_incidents"), n(~done).alias("active_open_incidents")
    ).withColumnRenamed("incident_state_", "incident_state").withColumn("_data_as_of", run_at)
