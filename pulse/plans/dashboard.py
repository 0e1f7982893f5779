"""The six report pages, each a name-to-frame mapping over the two tables.

Frames are lazy: a page costs nothing until one of its frames is shown.
"""

from pulse.plans import activity, categories, overview, status, stories, tools


def overview_page(posts, mentions):
    return {
        "kpis": overview.kpis_display(posts),
        "top_tools": tools.top_tools(mentions),
        "source_activity": overview.source_activity(posts),
        "top_posts": overview.top_posts_with_mentions(posts),
    }


def tools_page(posts, mentions):
    return {
        "rankings": tools.tool_rankings(mentions),
        "bars": tools.top20_tools(mentions),
        "matrix": tools.tool_source_pivot(mentions),
    }


def categories_page(posts, mentions, category=None):
    page = {
        "summary": categories.category_summary(mentions),
        "share": categories.category_share(mentions),
        "choices": categories.category_list(mentions),
    }
    if category is not None:
        page["drilldown"] = categories.category_drilldown(mentions, category)
    return page


def stories_page(posts, mentions, source=stories.ALL_SOURCES):
    return {
        "stories": stories.top_stories(posts, source),
        "histogram": stories.score_histogram(posts, source),
        "table": stories.stories_table(posts, source),
    }


def activity_page(posts, mentions):
    return {
        "hours": activity.hourly_activity(posts),
        "weekdays": activity.weekday_ordered(posts),
        "scores": activity.score_box(posts),
        "authors": activity.active_authors(posts),
    }


def status_page(posts, mentions):
    return {
        "totals": status.status_totals(posts, mentions),
        "recent_runs": status.recent_runs(posts),
    }


PAGES = {
    "overview": overview_page,
    "tools": tools_page,
    "categories": categories_page,
    "stories": stories_page,
    "activity": activity_page,
    "status": status_page,
}
